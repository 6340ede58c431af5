"""Audit of how document filters interact: every order of the filters, from one pass over the texts.

A table-driven byte transducer reads the UTF-8 bytes of a batch once. Its next state depends on the
state and the byte; each step may count a code point, a capital or a symbol and may open or close a word.
Every closed word goes as a span into an open-addressing hash table, where an entry only counts as
the same word after its bytes have been compared. What is shuffled are one hash and five bits a document.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_text, mix64, powers

# States of the transducer: between words, inside a word. A byte's class fixes where it leads.
OUT, IN = 0, 1
# What a step emits, as bits.
OPEN, CLOSE, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16
# Symbols that filter D looks for, and the letters of the filters.
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"
CHARS = 4_000_000


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state by byte, emission by state * 256 + byte) for words [^\\x20\\x09-\\x0D]+."""
    byte = np.arange(256)
    space = (byte == 32) | ((byte >= 9) & (byte <= 13))
    follow = np.where(space, OUT, IN).astype(np.uint8)
    emit = np.where(byte & 0xC0 != 0x80, POINT, 0)
    emit |= np.where((byte >= 65) & (byte <= 90), CAPITAL, 0)
    emit |= np.where(np.isin(byte, list(SYMBOLS)), SYMBOL, 0)
    from_out = emit | np.where(space, 0, OPEN)
    from_in = emit | np.where(space, CLOSE, 0)
    return follow, np.concatenate([from_out, from_in]).astype(np.uint8)


FOLLOW, EMIT = transducer()


class Measured:
    """Counts per text of a batch: words, distinct words, capitals, code points, symbols."""

    def __init__(self, blobs: list[bytes]):
        # A line feed ends each text, so the machine is between words where the next one begins.
        raw = np.frombuffer(b"\n".join(blobs) + b"\n" if blobs else b"", np.uint8)
        begin = np.concatenate([[0], np.cumsum(np.array([len(b) + 1 for b in blobs], np.int64))]).astype(np.int64)
        state = FOLLOW[raw]
        before = np.empty(len(raw), np.uint16)
        before[:1] = OUT
        before[1:] = state[:-1]
        out = EMIT[before << 8 | raw]
        self.points = _totals(out & POINT != 0, begin) - 1 if blobs else np.empty(0, np.int64)  # less the line feed
        self.capitals = _totals(out & CAPITAL != 0, begin)
        self.symbols = _totals(out & SYMBOL != 0, begin)
        start, end = np.flatnonzero(out & OPEN), np.flatnonzero(out & CLOSE)
        first = np.searchsorted(start, begin)
        self.words = np.diff(first)
        text = np.repeat(np.arange(len(blobs)), self.words)
        self.distinct = np.bincount(text[insert(raw, start, end, text)], minlength=len(blobs))


def _totals(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[begin[1:]] - sums[begin[:-1]]


def span_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, eight bytes at a time; shorter work for each further step."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(raw) + 1, "<u8", padded.data, strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
    value = mix64((end - start).astype(np.uint64))
    open_, at = np.arange(len(start)), start.copy()
    step = 0
    while len(open_):
        if step > 8:  # a few very long spans: by running sums instead of one round for each eight bytes
            return _long_spans(raw, start, end, value, open_)
        left = np.minimum(end[open_] - at, 8)
        value[open_] = mix64(value[open_] ^ (eights[at] & masks[left])) + np.uint64(0x9E37)
        more = end[open_] - at > 8
        open_, at = open_[more], at[more] + 8
        step += 1
    return value


def _long_spans(raw, start, end, value, which) -> np.ndarray:
    for i in which.tolist():
        piece = raw[start[i] : end[i]].astype(np.uint64) + np.uint64(1)
        value[i] = mix64(np.array([np.sum(piece * powers(len(piece)), dtype=np.uint64)]))[0]
    return value


def insert(raw: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Insert all spans into one hash table, per owner; returns the spans that were new, one for each distinct word.

    All spans probe at once. A span that finds its slot empty writes itself (one of those that meet there
    wins); a span whose slot holds one of the same owner, hash, length and bytes is a repeat; all
    others go on to their next slot.
    """
    count = len(start)
    if not count:
        return np.empty(0, np.int64)
    size = 1 << int(np.ceil(np.log2(2 * count + 1)))
    code = mix64(span_hash(raw, start, end) ^ mix64(owner.astype(np.uint64) + np.uint64(1)))
    table = np.full(size, -1, np.int64)
    slot = (code & np.uint64(size - 1)).astype(np.int64)
    step = ((code >> np.uint64(32)) | np.uint64(1)).astype(np.int64) & (size - 1)
    waiting = np.arange(count)
    while len(waiting):
        at = slot[waiting]
        empty = table[at] < 0
        table[at[empty]] = waiting[empty]
        held = table[at]
        other = held != waiting
        same = other & (code[held] == code[waiting]) & (owner[held] == owner[waiting])
        same[same] = same_bytes(raw, start, end, held[same], waiting[same])
        going = other & ~same
        waiting = waiting[going]
        slot[waiting] = (slot[waiting] + step[waiting]) & (size - 1)
    return table[table >= 0]


def same_bytes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the spans ``left`` and ``right`` hold the same bytes."""
    size = end[left] - start[left]
    equal = size == end[right] - start[right]
    pairs = np.flatnonzero(equal)
    if len(pairs):
        size = size[pairs]
        ends = np.cumsum(size)
        inside = np.arange(ends[-1]) - np.repeat(ends - size, size)
        differ = raw[np.repeat(start[left[pairs]], size) + inside] != raw[np.repeat(start[right[pairs]], size) + inside]
        equal[pairs] = np.add.reduceat(differ, ends - size, dtype=np.int64) == 0
    return equal


def measure(docs: DataFrame, key: str = "doc_id", part: str = "lang", text: str = "text") -> DataFrame:
    """(key, part, text_sha256, n_words, n_distinct, n_capitals, n_points, n_symbols) for every whole text.

    A NULL text is empty, a NULL part an empty string; NULL keys stay. One row a row, no shuffle; other columns are
    not read. Memory grows with the longest text.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

    def make(batch: pa.RecordBatch) -> dict:
        got = Measured([b or b"" for b in batch.column("_text").cast(pa.binary()).to_pylist()])
        counts = dict(zip(names, (got.words, got.distinct, got.capitals, got.points, got.symbols), strict=True))
        return {"_key": batch.column("_key"), "_part": batch.column("_part"), "_sha": batch.column("_sha"), **counts}

    clean = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
                       F.sha2(clean.cast("binary"), 256).alias("_sha"), clean.alias("_text"))
    schema = f"_key {kind}, _part string, _sha string, " + ", ".join(f"{n} bigint" for n in names)
    made = map_text(rows, "_text", schema, make, CHARS)
    return made.select(F.col("_key").alias(key), F.col("_part").alias("part"), F.col("_sha").alias("text_sha256"), *names)


def failures() -> Column:
    """Bits of the filters A to D that a row of ``measure`` fails (E needs the other rows)."""
    conditions = [F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"),
                  100 * F.col("n_capitals") > 3 * F.col("n_points"), F.col("n_symbols") > 0]
    return sum((F.when(c, F.lit(1 << n)).otherwise(F.lit(0)) for n, c in enumerate(conditions)), F.lit(0)).cast("int")


def failed_counts(measured: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, good, toxic, n): how many documents fail exactly the filters of ``mask``.

    Filter E fails where the same text has a smaller key. Equal texts are counted by key first, so a text that
    a third of all rows share is one row per key, then one per part and label; no group of equal texts
    ever meets in a task. A NULL key has no smaller one and is smaller than none. A key counts as good or toxic if any
    of its labels says so.
    """
    per_key = (measured.groupBy("text_sha256", "part", F.col(key).alias("_doc"), failures().alias("mask"))
               .agg(F.count(F.lit(1)).alias("n")))
    told = (labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_doc"))
            .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                 F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    known = per_key.join(told, "_doc", "left").select(
        "text_sha256", "part", "mask", "_doc", "n",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    groups = known.groupBy("text_sha256", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("_doc").alias("least"), F.min_by("n", "_doc").alias("n_least"),
        F.sum(F.when(F.col("_doc").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    # At most four rows a text and part.
    first = F.min("least").over(W.partitionBy("text_sha256"))
    own = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = groups.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), own.alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - own).alias("n")))).alias("x"))
    return (split.select("part", "good", "toxic", "x.*").where("n > 0")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


def audit_orders(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """The report of every order of the filters, from the counts of ``failed_counts``: at most 128 rows a part."""
    steps = [(order, k + 1, 1 << filters.index(order[k]), sum(1 << filters.index(f) for f in order[:k]))
             for order in map("".join, permutations(filters)) for k in range(len(order))]
    # All orders and their steps as one constant: rows of a part are dealt to each of them.
    text = json.dumps([{"o": o, "s": s, "bit": bit, "before": before} for o, s, bit, before in steps])
    listed = F.from_json(F.lit(text), "array<struct<o:string,s:int,bit:int,before:int>>")
    whole = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("all"))
    dealt = whole.select("part", "all", F.explode(listed).alias("_at"))
    bit, before = F.col("_at.bit"), F.col("_at.before")

    def total(condition) -> Column:
        return F.aggregate(F.filter("all", condition), F.lit(0).cast("bigint"), lambda a, x: a + x.n)

    def reached(x) -> Column:
        return x.mask.bitwiseAND(before) == 0

    def fails(x) -> Column:
        return x.mask.bitwiseAND(bit) != 0

    report = dealt.select(
        "part", F.col("_at.o").alias("filter_order"), F.col("_at.s").alias("step"),
        F.substring("_at.o", F.col("_at.s"), F.lit(1)).alias("_letter"),
        total(lambda x: reached(x) & ~fails(x)).alias("kept"), total(lambda x: reached(x) & fails(x)).alias("removed"),
        total(lambda x: ~reached(x) & fails(x)).alias("redundant"), total(lambda x: x.mask == bit).alias("unique_fails"),
        total(lambda x: reached(x) & fails(x) & x.good).alias("good_lost"),
        total(lambda x: reached(x) & fails(x) & x.toxic).alias("toxic_lost"))
    shapley = F.sum("removed").over(W.partitionBy("part", "_letter")).alias("shapley")
    return report.select("*", shapley).drop("_letter")


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "lang", text: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    NULL texts are empty and fail A alone (and E); an empty table has no parts and gives no rows. Repeated rows
    count as often as they come; rows with the same key are no copies of each other, as none has a smaller key. Extra columns
    are not read.
    """
    return audit_orders(failed_counts(measure(docs, key, part, text), labels, key))
