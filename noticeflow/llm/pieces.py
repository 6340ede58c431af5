"""SentencePiece encoding and decoding by vectorised merge rounds.

The texts of a batch become one flat array of code points, cut into words wherever
no piece of the vocabulary spans two neighbouring characters, so no merge can cross a
cut. Equal words are encoded once. The symbols of all distinct words lie in one array;
each round finds the least pair rank of every word, merges its occurrences from the left
at once and compacts the arrays, until no pair remains.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, worker_cache

SPACE = "▁"
# The rank of a pair that is no piece.
NEVER = np.iinfo(np.int32).max
# Characters of text a task encodes at a time.
CHARS = 2_000_000


class Model:
    """The tables of a BPE model with byte fallback, as arrays.

    Symbols are piece ids; characters that only occur inside pieces get numbers after them, and all others
    the negative number -1 - code point. The normalizer has to be the identity with a space in front.
    """

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lib.get_piece_size()
        if lib.normalize("Ａ ﬁ  b ") != f"{SPACE}Ａ{SPACE}ﬁ{SPACE * 2}b{SPACE}":
            raise ValueError("only models whose normalizer keeps the text and puts a space in front")
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(count)]
        names = {lib.id_to_piece(i): i for i in range(count) if not special[i]}
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(lib.is_byte(int(i)) for i in self.byte_ids) or any(lib.is_unused(i) for i in range(count)):
            raise ValueError("only models with byte fallback and without unused pieces")
        spelled = [b""] * count
        for name, i in names.items():
            spelled[i] = name.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            spelled[i] = bytes([b])
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.raw = np.frombuffer(b"".join(spelled), np.uint8)
        self.leading = np.array([s[:1] == b" " for s in spelled])

        known = dict(names)
        for n, c in enumerate(sorted({c for name in names for c in name} - set(names))):
            known[c] = count + n
        self.count = count
        self.symbol = -1 - np.arange(0x110000, dtype=np.int32)
        for name, i in known.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        scores = {i: lib.get_score(i) for i in names.values()}
        order = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        held = np.bincount([order[s] for s in scores.values()])
        self.tied = held > 1  # ranks that several pieces share
        self.ties: dict[tuple[int, int], tuple[int, int]] = {}  # pairs seen among those
        pairs = sorted((known[n[:k]] << 32 | known[n[k:]], i, order[scores[i]]) for n, i in names.items()
                       for k in range(1, len(n)) if n[:k] in known and n[k:] in known)
        self.pair = np.array([p[0] for p in pairs], np.int64)
        self.merged = np.array([p[1] for p in pairs], np.int32)
        self.rank = np.array([p[2] for p in pairs], np.int32)
        self.neighbours = np.array(sorted({ord(a) << 32 | ord(b) for n in names for a, b in zip(n, n[1:])}), np.int64)

    @staticmethod
    def of(path: str) -> Model:
        """The model of a file, read once per Python worker."""
        cache = worker_cache("pieces")
        if path not in cache:
            cache.clear()
            cache[path] = Model(path)
        return cache[path]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs of symbols; NEVER where they are no piece."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), max(0, len(self.pair) - 1))
        hit = (self.pair[at] == key) & (left >= 0) & (right >= 0) if len(self.pair) else np.zeros(len(key), bool)
        return np.where(hit, self.rank[at], NEVER), np.where(hit, self.merged[at], -1)


def take_runs(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs values[first:first + size], one after the other."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(first - (ends - size), size) + np.arange(ends[-1])]


def _leftmost(model: Model, symbols: np.ndarray, rank: int) -> list[int]:
    """Merges of one rank that several pieces share, always the leftmost pair; ends where a better pair appears."""
    done: list[int] = []
    rest = symbols.tolist()[::-1]
    pairs = model.ties

    def pair(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in pairs:
            found = model.look_up(np.array([a], np.int32), np.array([b], np.int32))
            if len(pairs) > 100_000:
                pairs.clear()
            pairs[a, b] = int(found[0][0]), int(found[1][0])
        return pairs[a, b]

    while rest:
        done.append(rest.pop())
        while True:
            if len(done) > 1 and (found := pair(done[-2], done[-1]))[0] <= rank:
                if found[0] < rank:
                    return done + rest[::-1]
                done[-2:] = [found[1]]
            elif rest and (found := pair(done[-1], rest[-1]))[0] <= rank:
                if found[0] < rank:
                    return done + rest[::-1]
                done[-1] = found[1]
                rest.pop()
            else:
                break
    return done


def merge_words(model: Model, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words after every merge, and the word of each.

    ``word`` ascends. A merge may make a pair of a rank below its own; then the occurrences to the
    right wait, for the library always takes the best pair, the leftmost among equals.
    """
    ready: list[tuple[np.ndarray, np.ndarray]] = []
    symbols, word = symbols.astype(np.int32), word.astype(np.int64)

    def ranks(left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, merged = model.look_up(left, right)
        return np.where(same, rank, NEVER), merged

    def after(values: np.ndarray, last: int) -> np.ndarray:
        return np.concatenate([values[1:], np.array([last], values.dtype)])

    rank, merged = ranks(symbols, after(symbols, -1), after(word, -1) == word)
    while len(symbols):
        # Per word: the least rank; words without a pair are ready.
        begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sizes = np.diff(np.concatenate([begin, [len(word)]]))
        least = np.minimum.reduceat(rank, begin)
        live = least < NEVER
        if not live.all():
            keep = np.repeat(live, sizes)
            ready.append((symbols[~keep], word[~keep]))
            symbols, word, rank, merged = symbols[keep], word[keep], rank[keep], merged[keep]
            begin, sizes, least = np.cumsum(sizes[live]) - sizes[live], sizes[live], least[live]
            if not len(symbols):
                break
        part = np.repeat(np.arange(len(begin)), sizes)
        alive = np.ones(len(symbols), bool)
        tied = np.flatnonzero(model.tied[least])
        for w in tied.tolist():
            a, b = begin[w], begin[w] + sizes[w]
            row = _leftmost(model, symbols[a:b], int(least[w]))
            symbols[a : a + len(row)] = row
            alive[a + len(row) : b] = False
        stale = np.zeros(len(symbols), bool)  # symbols whose pair has to be looked up again
        if len(tied):
            stale |= np.isin(part, tied)
        here = np.flatnonzero((rank == least[part]) & ~stale)
        if len(here):
            # Of pairs that overlap, every second one from the left.
            run = np.flatnonzero(np.concatenate([[True], np.diff(here) != 1]))
            place = np.arange(len(here)) - np.repeat(run, np.diff(np.concatenate([run, [len(here)]])))
            here = here[place % 2 == 0]
            made = merged[here]
            # The pairs a merge makes, with all merges to its left done and none to its right.
            left_at, right_at = np.maximum(here - 1, 0), np.minimum(here + 2, len(symbols) - 1)
            beside = np.concatenate([[False], here[1:] - here[:-1] == 2])
            left = np.where(beside, np.concatenate([made[:1], made[:-1]]), symbols[left_at])
            before = ranks(left, made, (here > 0) & (part[np.where(beside, here - 2, left_at)] == part[here]))[0]
            behind = ranks(made, symbols[right_at], (here + 2 < len(symbols)) & (part[right_at] == part[here]))[0]
            better = np.minimum(before, behind) <= rank[here]
            if better.any():
                # Nothing to the right of a word's first such merge is merged in this round.
                stop = np.full(len(begin), len(symbols))
                np.minimum.at(stop, part[here[better]], here[better])
                chosen = here <= stop[part[here]]
                here, made = here[chosen], made[chosen]
            symbols[here] = made
            alive[here + 1] = False
            stale[here] = True
            stale[np.maximum(here - 1, 0)] = True
            two = np.maximum(here - 2, 0)
            stale[two] |= ~alive[np.maximum(here - 1, 0)]
        symbols, word, rank, merged, stale = symbols[alive], word[alive], rank[alive], merged[alive], stale[alive]
        at = np.flatnonzero(stale)
        nxt = np.minimum(at + 1, len(symbols) - 1)
        rank[at], merged[at] = ranks(symbols[at], symbols[nxt], (nxt > at) & (word[nxt] == word[at]))
    if not ready:
        return symbols, word
    symbols, word = np.concatenate([s for s, _ in ready]), np.concatenate([w for _, w in ready])
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


def _fall_back(model: Model, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids: characters without a piece become the ids of their UTF-8 bytes."""
    if len(symbols) and symbols.max() >= model.count:
        own = np.full(symbols.max() + 1 - model.count, -1, np.int32)
        chars = np.flatnonzero(model.symbol >= model.count)
        fits = model.symbol[chars] - model.count < len(own)
        own[model.symbol[chars[fits]] - model.count] = -1 - chars[fits]
        symbols = np.where(symbols >= model.count, own[np.maximum(symbols - model.count, 0)], symbols)
    lost = np.flatnonzero(symbols < 0)
    if not len(lost):
        return symbols, word
    raw = (-1 - symbols[lost]).astype("<u4").tobytes().decode("utf-32-le").encode()
    code = -1 - symbols[lost]
    sizes = np.ones(len(symbols), np.int64)
    sizes[lost] = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    out = np.repeat(symbols, sizes)
    out[np.repeat(symbols < 0, sizes)] = model.byte_ids[np.frombuffer(raw, np.uint8)]
    return out, np.repeat(word, sizes)


def encode_batch(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in one array, and where each text begins (with the end as the last)."""
    shown = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
    points = np.frombuffer("".join(shown).encode("utf-32-le"), "<u4")
    begin = np.concatenate([[0], np.cumsum(np.array([len(s) for s in shown], np.int64))]).astype(np.int64)
    if not len(points):
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    pair = points[:-1].astype(np.int64) << 32 | points[1:]
    at = np.minimum(np.searchsorted(model.neighbours, pair), len(model.neighbours) - 1)
    cut = np.concatenate([[True], model.neighbours[at] != pair])
    cut[begin[:-1][begin[:-1] < len(points)]] = True
    edges = np.concatenate([np.flatnonzero(cut), [len(points)]])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer((edges * 4).astype(np.int64)), pa.py_buffer(points)])
    coded = words.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary
    offsets = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    flat = np.frombuffer(distinct.buffers()[2], "<u4")[offsets[0] // 4 : offsets[-1] // 4]
    owner = np.repeat(np.arange(len(distinct)), np.diff(offsets) // 4)
    symbols, owner = merge_words(model, model.symbol[flat], owner)
    symbols, owner = _fall_back(model, symbols, owner)
    size = np.bincount(owner, minlength=len(distinct))
    first = np.cumsum(size) - size
    ids = take_runs(symbols, first[which], size[which])
    ends = np.concatenate([[0], np.cumsum(size[which])])
    return ids, ends[np.searchsorted(edges[:-1], begin)]


def decode_batch(model: Model, ids: np.ndarray, begin: np.ndarray) -> list[str]:
    """The texts of runs of ids: the space put in front goes, bytes that are no UTF-8 become U+FFFD one by one.

    An id outside the vocabulary is an error; control pieces have no text.
    """
    if len(ids) and (ids.min() < 0 or ids.max() >= model.count):
        raise ValueError("an id outside the vocabulary")
    size = model.size[ids]
    raw = take_runs(model.raw, model.first[ids], size).tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[begin]
    texts = []
    for a, b, i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        skip = 1 if j > i and model.leading[ids[i]] else 0
        blob = raw[a + skip : b]
        try:
            texts.append(blob.decode())
        except UnicodeDecodeError:
            texts.append(_with_marks(blob))
    return texts


def _with_marks(blob: bytes) -> str:
    """UTF-8 with one U+FFFD for every byte that belongs to no character."""
    parts, at = [], 0
    while at < len(blob):
        try:
            parts.append(blob[at:].decode())
            break
        except UnicodeDecodeError as bad:
            parts.append(blob[at : at + bad.start].decode() + "�")
            at += bad.start + 1
    return "".join(parts)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the piece ids of every whole text, as the sentencepiece library gives them without begin or end ids.

    ``model`` is a file every executor can read. NULL is an empty text, which has no ids. One row a row:
    repeated rows and keys stay, other columns are not read, an empty table gives none. A text is encoded in one
    piece whatever its length; memory grows with the longest text. No shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> dict:
        ids, begin = encode_batch(Model.of(model), [t or "" for t in batch.column("_text").to_pylist()])
        lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return {"_key": batch.column("_key"), "ids": lists}

    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return map_text(rows, "_text", f"_key {kind}, ids array<int>", make, CHARS).withColumnRenamed("_key", key)


def decode(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, text): what the ids say, as the library's decode does. NULL or no ids: an empty text."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, 512)
                # At most about CHARS ids at a time, one row at least.
                sizes = np.cumsum(pc.list_value_length(part.column("ids")).to_numpy(zero_copy_only=False))
                part = part.slice(0, max(1, int(np.searchsorted(sizes, CHARS // 4, side="right"))))
                start += part.num_rows
                lists = part.column("ids")
                begin = lists.offsets.to_numpy().astype(np.int64)
                flat = lists.values.to_numpy(zero_copy_only=False)[begin[0] : begin[-1]]
                texts = decode_batch(Model.of(model), flat, begin - begin[0])
                yield pa.RecordBatch.from_arrays([part.column("_key"), lists, pa.array(texts, pa.string())],
                                                 names=["_key", "ids", "text"])

    given = rows.select(F.col(key).alias("_key"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    return given.mapInArrow(run, f"_key {kind}, ids array<int>, text string").withColumnRenamed("_key", key)


def digest(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of the rows of ``decode``."""
    return decoded.select(
        key, F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
