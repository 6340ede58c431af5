"""Size-bounded load batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.running import running_total
from ..schema import CHUNK_BYTES
from ..session import checkpointed
from ..sources.tables import CSV_OPTIONS, read_bounded_csv

ROW_END = 2  # CRLF


def csv_row_bytes(columns: Sequence[str]) -> Column:
    """UTF-8 bytes one row takes in a load file."""
    text = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    line = F.to_csv(text, {"quote": '"', "escape": '"', "emptyValue": ""})
    return (F.octet_length(line) + ROW_END).cast("bigint")


def size_bounded_batches(rows: DataFrame, order: Sequence[str], size: str, max_row: int,
                         max_bytes: int = CHUNK_BYTES, header_bytes: int = 0,
                         group: Sequence[str] = ()) -> DataFrame:
    """Add ``batch``: contiguous in ``order`` and never above ``max_bytes`` with the header.

    A row belongs to the batch its start offset falls in. Offsets are cut every
    ``max_bytes - header - max_row`` bytes, so a batch holds at most the limit.
    The offset is a distributed running sum; pass only the order columns and the
    size. A row that cannot fit at all is an error.
    """
    width = max_bytes - header_bytes - max_row
    if width <= 0:
        raise ValueError(f"a single row of {max_row} bytes does not fit into {max_bytes}")
    totals = running_total(rows, size, order, group, name="_end")
    batch = F.floor((F.col("_end") - F.col(size)) / F.lit(width)).cast("bigint")
    return totals.withColumn("batch", batch).drop("_end")


# Full batches in a stretch, the unit that is looked at in one piece. It does not change the result.
STRETCH = 8
# Stretches whose jumps are composed at a time.
FANOUT = 16
NONE = -1


def _jumps(room: int, width: int):
    """For rows of a stretch: from each row that may open a batch to the first one opened in the next stretch."""

    def jump(frame: pd.DataFrame) -> pd.DataFrame:
        place = int(frame["_at"].iloc[0])
        start, taken = frame["_start"].to_numpy(), frame["_size"].to_numpy()
        order = np.lexsort((taken, start))
        start, taken = start[order], taken[order]
        if taken.max() > room:
            raise ValueError(f"a single row of {taken.max()} bytes does not fit into {room}")
        own = int(np.searchsorted(start, (place + 1) * width))
        # A batch begun before the stretch ends within the first ``room`` bytes of it.
        first = np.flatnonzero((start[:own] < place * width + room) & (taken[:own] > 0))
        # The batch of row i ends before the first row whose end is out of reach.
        beyond = np.searchsorted(start + taken, start + room, side="right")
        at, batches = first.copy(), np.ones(len(first), np.int64)
        while (inside := beyond[at] < own).any():
            at, batches = np.where(inside, beyond[at], at), batches + inside
        out = np.minimum(beyond[at], len(start) - 1)
        left = np.where(beyond[at] < len(start), start[out], NONE)
        return pd.DataFrame({"_at": place, "_entry": start[first], "_exit": left, "_batches": batches})

    return jump


def _by_stretch(frame: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    ordered = frame.sort_values("_entry")
    return {int(at): tuple(part[c].to_numpy() for c in ("_entry", "_exit", "_batches")) for at, part in ordered.groupby("_at")}


def _compose(frame: pd.DataFrame) -> pd.DataFrame:
    """The jumps over FANOUT stretches from those over each of them."""
    parts = _by_stretch(frame)
    base = min(parts) // FANOUT * FANOUT
    entry, left, batches = parts.get(base, (np.empty(0, np.int64),) * 3)
    for at in range(base + 1, base + FANOUT):
        if at in parts and (left != NONE).any():
            own, far, more = parts[at]
            place = np.minimum(np.searchsorted(own, left), len(own) - 1)
            batches = batches + np.where(left == NONE, 0, more[place])
            left = np.where(left == NONE, NONE, far[place])
    return pd.DataFrame({"_at": base // FANOUT, "_entry": entry, "_exit": left, "_batches": batches})


def _descend(frame: pd.DataFrame) -> pd.DataFrame:
    """The entry of each of FANOUT stretches from the one of all of them."""
    parts = _by_stretch(frame)
    entry, number = int(frame["_in"].iloc[0]), int(frame["_first"].iloc[0])
    base, found = min(parts) // FANOUT * FANOUT, []
    for at in range(base, base + FANOUT):
        found.append((at, entry, number))
        if entry != NONE and at in parts:
            own, far, more = parts[at]
            place = int(np.searchsorted(own, entry))
            if place < len(own) and own[place] == entry:
                entry, number = int(far[place]), number + int(more[place])
    return pd.DataFrame(found, columns=["_at", "_entry", "_number"])


def _entries(jumps: DataFrame, stretches: int) -> DataFrame:
    """(_at, _entry, _number): where the first batch opened in each stretch starts (NONE: none is), and its number.

    Jumps over one stretch are composed to jumps over FANOUT, FANOUT squared and so on; each level has a
    FANOUT-th of the rows of the one below. Then the one start of the whole input is taken down the levels again.
    """
    schema, levels = jumps.schema, [jumps]
    while (stretches := -(-stretches // FANOUT)) > 1:
        levels[-1] = checkpointed(levels[-1])
        levels.append(levels[-1].groupBy(F.expr(f"_at div {FANOUT}")).applyInPandas(_compose, schema))
    entries = jumps.sparkSession.createDataFrame([(0, 0, 0)], "_group long, _in long, _first long")
    for low in reversed(levels):
        here = low.withColumn("_group", F.expr(f"_at div {FANOUT}")).join(entries, "_group")
        found = here.groupBy("_group").applyInPandas(_descend, "_at long, _entry long, _number long")
        entries = found.toDF("_group", "_in", "_first")
    return found


def greedy_batches(rows: DataFrame, order: Sequence[str], size: str, max_bytes: int = CHUNK_BYTES,
                   header_bytes: int = 0, stretch: int = STRETCH) -> DataFrame:
    """Add ``batch``: each is filled as far as it goes before the next one is opened, in ``order``, from 0.

    The cuts are those of one pass over all rows, but no task sees them all. Rows are dealt to stretches of the
    running total, ``stretch`` times the room of a batch long. A stretch tells, for each row that may open a batch in it,
    where the first batch of the next stretch would start; these jumps are composed to the one true entry of each stretch, and
    the stretches fill their batches side by side. ``order`` must be unique and not NULL, sizes not NULL
    and not negative; a row that cannot fit is an error. A stretch's offsets are held in memory, not its rows.
    """
    room = max_bytes - header_bytes
    if room <= 0:
        raise ValueError("the header alone exceeds the limit")
    if stretch < 2:
        raise ValueError("a stretch must hold two batches")
    width = stretch * room
    ends = running_total(rows.select(*order, F.col(size).cast("bigint").alias("_size")), "_size", order, name="_end")
    placed = checkpointed(ends.select(*order, "_size", (F.col("_end") - F.col("_size")).alias("_start"))
                          .withColumn("_at", F.expr(f"_start div {width}")))
    # Rows that the batch of the stretch before may reach go there as well.
    ahead = F.when((F.col("_start") < F.col("_at") * width + room) & (F.col("_at") > 0), F.array(F.col("_at"), F.col("_at") - 1))
    dealt = placed.select("_start", "_size", F.explode(F.coalesce(ahead, F.array("_at"))).alias("_at"))
    jumps = dealt.groupBy("_at").applyInPandas(_jumps(room, width), "_at long, _entry long, _exit long, _batches long")
    last = placed.agg(F.max("_at")).first()[0]
    entries = _entries(jumps, (last or 0) + 1)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, used = None, 0, None
        for batch in batches:
            numbers = []
            values = zip(*(batch.column(c).to_pylist() for c in ("_at", "_start", "_size", "_entry", "_number")), strict=True)
            for at, start, taken, entry, first in values:
                if at != place and first is None:  # nothing but empty rows so far
                    place, number, used = at, 0, 0
                elif at != place:  # rows before the entry end the last batch of the stretch before
                    place, number, used = at, first - 1, None
                if used is None:
                    if entry not in (None, NONE) and (start > entry or start == entry and (taken or not at)):
                        number, used = first, 0
                elif used + taken > room:
                    number, used = number + 1, 0
                if used is not None:
                    used += taken
                numbers.append(number)
            columns = [batch.column(c) for c in (*order, "_size")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int64())], names=[*order, "_size", "batch"])

    sorted_rows = placed.join(entries, "_at", "left").repartition("_at").sortWithinPartitions("_at", *order)
    schema = placed.select(*order, "_size").withColumn("batch", F.lit(None).cast("bigint")).schema
    return sorted_rows.mapInArrow(fill, schema).withColumnRenamed("_size", size)


def write_load_chunks(df: DataFrame, batches: DataFrame, key: Sequence[str], path: str, columns: Sequence[str]) -> None:
    """One load file with a header per batch: folder ``batch=N`` below ``path``.

    ``batches`` has the key and ``batch``; all rows of a batch meet in one task, which the batch size bounds.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    placed = df.join(batches.select(*key, "batch"), list(key)).select("batch", *text)
    (placed.repartition("batch").write.mode("errorifexists").partitionBy("batch")
     .options(**CSV_OPTIONS).csv(path))


def read_load_chunks(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(batch, columns) of all chunk files, with the bytes of each file as ``_bytes``."""
    rows = read_bounded_csv(spark, path, columns)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=([0-9]+)/", 1).cast("bigint")
    return rows.select(number.alias("batch"), *columns, F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_size").alias("_bytes"))
