"""Packing along a space-filling curve.

Each document's tokens give a hashed bag-of-tokens vector, projected to DIMS
dimensions; its cell on a Hilbert curve is the sort key. Rows are range-sorted by
it, and each range packs its documents one after another into sequences of LENGTH
tokens, cutting a document where a sequence is full. What is left at the end of
a range is cut into sequences of a power of two, which need no padding.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeflow.llm.common import Words, cut, map_text, mix64, worker_cache

LENGTH, END_ID = 2048, 1
DIMS, BITS, BUCKETS = 4, 8, 1024
# Entries and ids that each table of a worker holds at most, besides those of one batch; a full table starts anew.
MOST_CHUNKS, MOST_WORDS, MOST_IDS = 2_000_000, 500_000, 16_000_000
# Bytes of text that are encoded at a time.
CHARS = 1_000_000
# Bytes that lead characters from U+0300 on: combining marks are among them. Texts without any can be lower-cased in
# ASCII first, which lets more chunks be equal and changes no id.
WIDE = re.compile(rb"[\xcc-\xff]")

# A word of Latin letters with ASCII punctuation after it, but no apostrophe: the
# tokenizer cuts such a chunk into just these two parts.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class Known:
    """Token ids of pieces of text, in a table sorted by hash; length and first bytes are compared as well."""

    def __init__(self, most: int):
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.hash, self.head = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int32)
        self.pool = np.empty(0, "<u2")

    def forget_if_full(self) -> None:
        if len(self.hash) > self.most or len(self.pool) > MOST_IDS:
            self.forget()

    def lookup(self, hashes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start in the pool and number of ids of each piece; a start of -1 says that it is unknown."""
        if not len(self.hash):
            return np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        known = (self.hash[place] == hashes) & (self.head[place] == heads)
        return np.where(known, self.start[place], -1).astype(np.int64), self.size[place].astype(np.int64)

    def add(self, hashes: np.ndarray, heads: np.ndarray, found: list[bytes]) -> None:
        """New pieces, in order of hash; a hash that is there already keeps its piece."""
        at = np.searchsorted(self.hash, hashes)
        new = self.hash[np.minimum(at, len(self.hash) - 1)] != hashes if len(self.hash) else np.ones(len(hashes), bool)
        hashes, heads, at = hashes[new], heads[new], at[new]
        found = [f for f, n in zip(found, new.tolist(), strict=True) if n]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 2
        start = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(found), "<u2")])
        for name, values in (("hash", hashes), ("head", heads), ("start", start), ("size", size)):
            setattr(self, name, np.insert(getattr(self, name), at, values))


class ChunkIds:
    """Token ids of white-space separated chunks, remembered between texts.

    Holds for tokenizers whose normaliser and pre-tokenizer never look across ASCII white space
    and drop it, that ignore case, and that mark the last token of each word (``</w>``), such as the word-end BPE.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task has one core; the tokenizer's own threads would each keep memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.word_end = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.chunks, self.words = Known(MOST_CHUNKS), Known(MOST_WORDS)

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk, asked of the tokenizer."""
        self.words.forget_if_full()
        parts, last = [], []  # the words and tails of all simple chunks, and where those of each chunk end
        for chunk in chunks:
            simple = SIMPLE.fullmatch(chunk.decode())
            if simple is not None:
                parts.append(simple[1].lower())
                if simple[2]:
                    parts.append(simple[2])
            last.append(len(parts))
        ids = self._ids_of_words(parts)
        found, first = [], 0
        for z in last:
            own = ids[first:z]
            found.append(b"".join(own) if own and None not in own else None)
            first = z
        rest = [chunk.decode() for chunk, f in zip(chunks, found, strict=True) if f is None]
        made = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [np.array(next(made).ids, "<u2").tobytes() if f is None else f for f in found]

    def _ids_of_words(self, parts: list[str]) -> list[bytes | None]:
        """The ids of each word or tail; None where another has the same hash."""
        if not parts:
            return []
        spans = Words([" ".join(parts).encode()])
        heads = spans.heads()
        start, size = self.words.lookup(spans.hash, heads)
        missing = np.flatnonzero(start < 0)
        if len(missing):
            hashes, first = np.unique(spans.hash[missing], return_index=True)
            first = missing[first]
            self.words.add(hashes, heads[first], self._learn_words([parts[w] for w in first.tolist()]))
            start[missing], size[missing] = self.words.lookup(spans.hash[missing], heads[missing])
        pool = self.words.pool
        return [pool[a:a + n].tobytes() if a >= 0 else None for a, n in zip(start.tolist(), size.tolist(), strict=True)]

    def _learn_words(self, words: list[str], group: int = 64) -> list[bytes]:
        lines, found = [" ".join(words[i:i + group]) for i in range(0, len(words), group)], []
        for start, made in zip(range(0, len(words), group),
                               self.tokenizer.encode_batch_fast(lines, add_special_tokens=False), strict=True):
            ids = np.array(made.ids, "<u2")
            bounds = (np.flatnonzero(self.word_end[ids]) + 1).tolist()
            if len(bounds) != len(words[start:start + group]):
                raise ValueError("the tokenizer doesn't mark word ends")
            raw, begin = ids.tobytes(), 0
            for end in bounds:
                found.append(raw[2 * begin:2 * end])
                begin = end
        return found

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the bounds of each text; the end id closes each."""
        words = Words([t if WIDE.search(t) else t.lower() for t in texts])
        heads = words.heads()
        self.chunks.forget_if_full()
        start, size = self.chunks.lookup(words.hash, heads)
        missing = np.flatnonzero(start < 0)
        if len(missing):
            hashes, first = np.unique(words.hash[missing], return_index=True)
            first = missing[first]
            raw = words.raw.tobytes()
            found = self.ids_of([raw[a:z] for a, z in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)])
            self.chunks.add(hashes, heads[first], found)
            start[missing], size[missing] = self.chunks.lookup(words.hash[missing], heads[missing])
        pool, odd = self.chunks.pool, np.flatnonzero(start < 0)
        if len(odd):  # the same hash as another chunk: not remembered
            found = self.ids_of([words.raw[words.start[w]:words.end[w]].tobytes() for w in odd])
            size[odd] = [len(f) // 2 for f in found]
            start[odd] = len(pool) + np.cumsum(size[odd]) - size[odd]
            pool = np.concatenate([pool, np.frombuffer(b"".join(found), "<u2")])
        total = np.concatenate([[0], np.cumsum(size)])
        ids = pool[np.arange(total[-1]) + np.repeat(start - total[:-1], size)]
        last = total[words.first[1:]]
        return np.insert(ids, last, END_ID), np.concatenate([[0], last + np.arange(1, len(last) + 1)])


def chunk_ids(path: str) -> ChunkIds:
    cache = worker_cache("chunk_ids")
    if path not in cache:
        cache[path] = ChunkIds(path)
    return cache[path]


def projection(vocabulary: int = 1 << 16) -> np.ndarray:
    """For each token id the projected direction of its bucket."""
    directions = np.random.default_rng(20).standard_normal((BUCKETS, DIMS)).astype(np.float32)
    return directions[(mix64(np.arange(1, vocabulary + 1, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)]


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows, dims), by Skilling's transform (2004)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:  # undo the excess rotations, coarsest level first
        low = level - 1
        for d in range(dims):
            high = (x[d] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            x[d] ^= swap
        level >>= 1
    for d in range(1, dims):  # Gray encode
        x[d] ^= x[d - 1]
    flip, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> bit & 1)
    return key


def curve_keys(ids: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert key of each document; each has at least its end id."""
    sums = np.add.reduceat(table[ids], bounds[:-1], axis=0)
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    cells = np.clip(((unit + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return hilbert(cells, BITS)


def tokenized(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_key, _curve, _row, _ids) of every row; _ids: little-endian unsigned 16-bit ids, end id included."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text"))

    def make(batch: pa.RecordBatch) -> dict:
        cache = worker_cache("projection")
        if not cache:
            cache["table"] = projection()
        texts = [t or b"" for t in batch.column("_text").cast(pa.binary()).to_pylist()]
        ids, bounds = chunk_ids(path).encode(texts)
        raw, blobs = ids.tobytes(), []
        for a, z in zip(bounds[:-1], bounds[1:], strict=True):
            blobs.append(raw[2 * a:2 * z])
        return {"_key": batch.column("_key"), "_row": batch.column("_row"), "_ids": blobs,
                "_curve": curve_keys(ids, bounds, cache["table"])}

    return map_text(rows, "_text", f"_key {kind}, _curve bigint, _row bigint, _ids binary", make, CHARS)


class Range:
    """Sequences of one range; ids of sequences hold the number of the range in their upper bits."""

    def __init__(self, number: int):
        self.sequence, self.room, self.offset = number << 32, LENGTH, 0

    def place(self, size: int):
        """(start, length, sequence, offset) of the pieces of a document of that size."""
        start = 0
        while start < size:
            length = min(self.room, size - start)
            piece = start, length, self.sequence, self.offset
            start, self.room, self.offset = start + length, self.room - length, self.offset + length
            if not self.room:
                self.sequence, self.room, self.offset = self.sequence + 1, LENGTH, 0
            yield piece


def tail_pieces(pieces: list[tuple], total: int):
    """Deal the pieces of an unfinished sequence of ``total`` tokens out to sequences of falling powers of two."""
    sequence, room, offset = pieces[0][2], 1 << (total.bit_length() - 1), 0
    left = total
    for start, length, _, _, *rest in pieces:
        while length:
            part = min(length, room)
            yield (start, part, sequence, offset, *rest)
            start, length, room, offset, left = start + part, length - part, room - part, offset + part, left - part
            if not room and left:
                sequence, room, offset = sequence + 1, 1 << (left.bit_length() - 1), 0


def pack(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces (key, start, length, doc_tokens, sequence_id, offset, ids) of all rows.

    ids holds the piece's tokens as little-endian unsigned 32-bit numbers. Each
    row is packed on its own: NULL keys and repeated rows are kept, a NULL or empty text is its end
    id alone. Equal curve keys are split by row, so copies share out over ranges. An
    empty table gives no rows. No task holds more than one batch and one unfinished sequence.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = cut(tokenized(docs, path, text, key))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "_curve", "_row").sortWithinPartitions("_curve", "_row")
    columns = ["_key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = f"_key {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint, ids binary"

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        space, waiting, out = Range(TaskContext.get().partitionId()), [], []

        def batch_of(pieces):
            fields = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(fields, arrow, strict=True)],
                                              schema=arrow)

        def ids_of(piece):
            start, length, sequence, offset, name, size, ids = piece
            return name, start, length, size, sequence, offset, ids[start:start + length].astype("<u4").tobytes()

        for batch in batches:
            for name, blob in zip(batch.column("_key").to_pylist(), batch.column("_ids"), strict=True):
                ids = np.frombuffer(blob.as_buffer(), "<u2")
                for piece in space.place(len(ids)):
                    waiting.append((*piece, name, len(ids), ids))
                    if space.offset == 0:  # that piece filled its sequence
                        out += map(ids_of, waiting)
                        waiting = []
                if len(out) >= 2000:
                    yield batch_of(out)
                    out = []
        if waiting:
            out += map(ids_of, tail_pieces(waiting, space.offset))
        if out:
            yield batch_of(out)

    return ordered.select("_key", "_ids").mapInArrow(run, schema).select(*columns).withColumnRenamed("_key", key)


def digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract columns."""
    return pieces.select(key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
