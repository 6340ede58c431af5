"""Helpers shared by the text operators."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A word is a run of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Rows and characters that a task function takes at a time; they bound the memory of its arrays.
BATCH_ROWS, BATCH_CHARS = 512, 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so later tasks find it filled.

    Task functions are sent by value and get fresh globals in each task.
    """
    module = sys.modules.setdefault("_noticeflow_worker_cache", types.ModuleType("_noticeflow_worker_cache"))
    return module.__dict__.setdefault(name, {})


def small_batches(batches: Iterator[pa.RecordBatch], column: str, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most BATCH_ROWS rows and about ``chars`` bytes of ``column``."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, BATCH_ROWS)
            sizes = np.cumsum(pc.binary_length(part.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
            rows = max(1, int(np.searchsorted(sizes, chars, side="right")))
            yield part.slice(0, rows)
            start += min(rows, part.num_rows)


def map_text(rows: DataFrame, column: str, schema: str, make: Callable[[pa.RecordBatch], dict],
             chars: int = BATCH_CHARS) -> DataFrame:
    """Run ``make`` over bounded Arrow batches; it returns the output columns by name."""

    kind = T.StructType.fromDDL(schema)
    names = kind.fieldNames()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kind)
        for batch in small_batches(batches, column, chars):
            made = make(batch)
            yield pa.RecordBatch.from_arrays([_array(made[n], arrow.field(n).type) for n in names], schema=arrow)

    return rows.mapInArrow(run, kind)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


# --- hashing of words over a whole batch -------------------------------------------------

_MIX1, _MIX2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


# The inverse of the base of ``powers`` modulo 2^64.
_UNDO = pow(int(_BASE), -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def powers(count: int, base: int = int(_BASE)) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64."""
    if count == 0:
        return np.empty(0, np.uint64)
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Words:
    """The words of a batch of texts: byte positions and 64-bit hashes.

    ``raw`` holds the texts as UTF-8 bytes, each followed by a line feed. Word i
    is raw[start[i]:end[i]] and belongs to text ``row[i]``; the words of text r are
    first[r] .. first[r + 1].
    """

    def __init__(self, texts: pa.Array | list[bytes], change: bytes | None = None):
        blobs = texts if isinstance(texts, list) else [b.as_py() or b"" for b in texts.cast(pa.binary())]
        if change is not None:  # a byte-for-byte translation
            blobs = [b.translate(change) for b in blobs]
        self.texts = len(blobs)
        joined = b"\n".join(blobs) + b"\n" if blobs else b""
        self.raw = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter((len(b) + 1 for b in blobs), np.int64, len(blobs))
        self.begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        inside = ~((self.raw == 32) | ((self.raw >= 9) & (self.raw <= 13)))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.begin)
        self.row = np.repeat(np.arange(self.texts), np.diff(self.first))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, np.uint64)
        # A polynomial over the bytes, from running sums: the power at the word's start is divided out.
        sums = np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * powers(len(self.raw)), dtype=np.uint64)
        before = np.where(self.start > 0, sums[self.start - 1], np.uint64(0))
        value = (sums[self.end - 1] - before) * powers(len(self.raw), _UNDO)[self.start]
        return mix64(value ^ mix64((self.end - self.start).astype(np.uint64)))

    def heads(self) -> np.ndarray:
        """The first seven bytes of each word and its length (modulo 256) as one number."""
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.raw), "<u8", padded.data, strides=(1,))[self.start]
        size = self.end - self.start
        masks = np.array([(1 << 8 * n) - 1 for n in range(8)], np.uint64)
        return eight & masks[np.minimum(size, 7)] | size.astype(np.uint64) << np.uint64(56)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every run of ``width`` words; a shorter text that has words gives one of all its words."""
        count = np.diff(self.first)
        if not len(self.hash):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        wide = np.zeros(len(self.hash), np.uint64)
        for j, p in enumerate(powers(width)):
            wide[: len(self.hash) - j] += self.hash[j:] * p
        place = np.arange(len(self.hash)) - self.first[self.row]
        short = count[self.row] < width
        keep = np.where(short, place == 0, place <= count[self.row] - width)
        if short.any():  # sums over the whole short text instead
            own = np.where(short, self.hash * powers(width)[np.minimum(place, width - 1)], np.uint64(0))
            some = np.flatnonzero(count > 0)
            totals = np.zeros(self.texts, np.uint64)
            totals[some] = np.add.reduceat(own, self.first[some])
            wide = np.where(short, totals[self.row] + np.uint64(1), wide)
        return self.row[keep], mix64(wide[keep])


def nullable(schema):
    """The schema with every column nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def keep_rows(docs: DataFrame, column: str, wanted: Callable[[pa.Array], list]) -> DataFrame:
    """The rows for whose ``column`` ``wanted`` gives true, all columns as they are; no shuffle."""

    def run(batches):
        for batch in small_batches(batches, column):
            yield batch.filter(pa.array(wanted(batch.column(column)), pa.bool_()))

    return docs.mapInArrow(run, nullable(docs.schema))


def cut(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder and read from there."""
    from noticeflow.session import shared_dir

    shared_dir(rows.sparkSession, "checkpoint")  # sets a folder where the cluster names none
    return rows.checkpoint()
