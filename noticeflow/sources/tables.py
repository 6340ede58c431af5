"""Readers for load files, checkpoints, summaries, targets and logs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CHECKPOINT_SCHEMA
from ..session import checkpointed

# Blanks at the ends of a value belong to it.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


# At most so many blocks are sent to all tasks, about 100 MB; with more, the lines are shuffled to their blocks.
BROADCAST_BLOCKS = 500_000
BLOCK, RECORD = "path string, block bigint, parity int, even bigint, odd bigint", "path string, block bigint, number bigint, at bigint, record string"
BLOCK_ROWS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("parity", pa.int32()), ("even", pa.int64()), ("odd", pa.int64())])
RECORD_ROWS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("at", pa.int64()), ("record", pa.string())])
Lines = Iterator[tuple[tuple[str, int], bool, pa.RecordBatch, np.ndarray]]


def _by_block(batches: Iterator[pa.RecordBatch]) -> Lines:
    """(block, is its first piece, lines, parity of the quotes of each line), in order."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, places = batch.column("path"), batch.column("block").to_numpy()
        changed = (places[1:] != places[:-1]) | pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        odd = pc.count_substring(batch.column("value"), '"').to_numpy() % 2
        for start, end in zip(cuts, cuts[1:], strict=False):
            block = (paths[start].as_py(), int(places[start]))
            yield block, block != last, batch.slice(start, end - start), odd[start:end]
            last = block


def _block_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: parity of its quotes, and how many lines begin after an even and after an odd number of its quotes."""
    def row(block, parity, counts):
        return pa.RecordBatch.from_pylist(
            [{"path": block[0], "block": block[1], "parity": parity, "even": counts[0], "odd": counts[1]}], BLOCK_ROWS)

    block, parity, counts = None, 0, [0, 0]
    for current, is_first, _, odd in _by_block(batches):
        if is_first:
            if block:
                yield row(block, parity, counts)
            block, parity, counts = current, 0, [0, 0]
        before = (parity + np.cumsum(odd) - odd) % 2
        counts[0] += int((before == 0).sum())
        counts[1] += int(before.sum())
        parity = int(parity + odd.sum()) % 2
    if block:
        yield row(block, parity, counts)


def _assembler(whole: bool):
    """Records that lie in one block, or the pieces of those that cross its ends. A task holds a batch of lines and an open record."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            arrays = [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), RECORD_ROWS, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=RECORD_ROWS)

        block, crosses, inside, number, parts, held = None, False, 0, 0, [], None
        for current, is_first, lines, odd in _by_block(batches):
            if is_first:
                if parts and not whole:
                    rows.append((block[0], *held, block[1], "\n".join(parts)))
                block, inside, number, parts = current, lines.column("inside")[0].as_py(), 0, []
                crosses = inside == 1
                held = (lines.column("open_block")[0].as_py(), lines.column("open_number")[0].as_py())
            for value, toggles in zip(lines.column("value").to_pylist(), odd.tolist(), strict=True):
                if not inside and not parts:
                    number += 1
                    held = (block[1], number)
                parts.append(value)
                inside ^= toggles
                if not inside:
                    if crosses != whole:
                        rows.append((block[0], *held, block[1], "\n".join(parts)))
                    parts, crosses = [], False
            if rows:
                yield packed()
        if parts and not whole:
            rows.append((block[0], *held, block[1], "\n".join(parts)))
            yield packed()

    return assemble


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, number, record): the records of CSV files, cut at line ends outside quotes; large files by many tasks.

    Spark cuts a file into blocks of lines. Whether a block begins inside a quoted field follows from the number of quotes
    in the blocks before it, a running sum over one small row per block. Records are put together in the task of their block;
    only pieces of those that cross from block to block are shuffled, two a block at most, and the rows of blocks are checkpointed. A record is numbered in the block it begins in.
    Quotes inside fields must be doubled, as load files have them. A file that ends inside quotes fails the job.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    blocks = lines.select("path", "block", "value").mapInArrow(_block_states, BLOCK)
    # The record that a block begins in has begun in the last block before it that begins any.
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(earlier) % 2, F.lit(0)).cast("int")
    cut_short = F.sum("parity").over(Window.partitionBy("path")) % 2 == 1
    begun = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    opened = blocks.withColumn("inside", F.when(cut_short, F.raise_error(F.concat(F.lit("file ends inside quotes: "), "path")).cast("int"))
                               .otherwise(inside)).withColumn("begun", begun)
    last = F.last(F.when(F.col("begun") > 0, F.struct("block", F.col("begun").alias("number"))), True).over(earlier)
    opened = opened.select("path", "block", "inside", last.alias("o")).select(
        "path", "block", "inside", F.col("o.block").alias("open_block"), F.col("o.number").alias("open_number"))
    opened = checkpointed(opened)
    if opened.count() <= BROADCAST_BLOCKS:
        opened = F.broadcast(opened)
    placed = lines.join(opened, ["path", "block"]).sortWithinPartitions("path", "block", "line")
    pieces = F.array_sort(F.collect_list(F.struct("at", "record")))
    crossing = (placed.mapInArrow(_assembler(False), RECORD).groupBy("path", "block", "number").agg(pieces.alias("p"))
                .select("path", "block", "number", F.array_join(F.transform("p", lambda piece: piece["record"]), "\n").alias("record")))
    return placed.mapInArrow(_assembler(True), RECORD).drop("at").unionByName(crossing)


def read_bounded_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Load files of a bounded size, each read by one task in the JVM; otherwise as ``read_load_csv``."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return (spark.read.schema(schema).options(**CSV_OPTIONS)
            .option("multiLine", True).option("maxCharsPerColumn", -1).csv(path))


def read_load_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Load files with a header each, quoted multi-line text and fields of any length; one large file is read by many tasks.

    All columns are text. For files that ``write_load_chunks`` keeps small, ``read_bounded_csv`` is cheaper. Blank lines outside quotes are no records; records may end in CRLF.
    """
    schema = ", ".join(f"`{name}` string" for name in columns)
    records = quoted_records(spark, path).where(~((F.col("block") == 0) & (F.col("number") == 1)))
    options = {**{name: str(value).lower() for name, value in CSV_OPTIONS.items()}, "header": "false", "multiLine": "true", "lineSep": "\n", "maxCharsPerColumn": "-1"}
    record = F.regexp_replace("record", "\r$", "")
    return (records.select(record.alias("record")).where("record <> ''")
            .select(F.from_csv("record", schema, options).alias("r")).select("r.*"))


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Completed days as JSON lines; blank lines are skipped.

    A line without a readable date is kept, with NULL fields and its text in
    ``unreadable``; ``checkpoint_valid`` rejects it.
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parsed = lines.select("value", F.from_json("value", CHECKPOINT_SCHEMA).alias("d"))
    return parsed.select("d.*", F.when(F.col("d.date").isNull(), F.col("value")).alias("unreadable"))


def read_summaries(spark: SparkSession, path: str, schema: T.StructType,
                   include: str = "*-summary.json", exclude: Sequence[str] = ()) -> DataFrame:
    """One JSON document per file plus file name and time; unreadable files give NULL fields."""
    rows = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("pathGlobFilter", include).json(path)
            .select("*", F.col("_metadata.file_name").alias("_file"),
                    F.col("_metadata.file_modification_time").alias("_modified")))
    for token in exclude:
        rows = rows.where(~F.contains("_file", F.lit(token)))
    return rows


def read_target(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
                fmt: str = "parquet", **options: str) -> DataFrame:
    """Target snapshot from any Spark source; only ``columns`` are read."""
    rows = spark.read.format(fmt).options(**options).load(source)
    return rows.select(*columns) if columns else rows


# Fixed pattern of the result line of a run log.
RESULT_LINE = r"Salesforce 同步：\s*(\{[^\r\n]+\})"


def read_logs(spark: SparkSession, path: str, pattern: str = RESULT_LINE) -> DataFrame:
    """(path, result): last readable result line of each run log, as ``MAP<STRING, STRING>``.

    Logs are read line by line, so one of any size is shared out over tasks; the place of
    a line is its block and its number within it. A log without a result has a NULL one.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), result_of_line("value", pattern).alias("result"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("place"))
    read = F.col("result").isNotNull()
    return lines.groupBy("path").agg(F.max_by(F.to_json("result"), F.when(read, F.col("place"))).alias("r")).select(
        "path", F.from_json("r", T.MapType(T.StringType(), T.StringType())).alias("result"))


# A name outside quotes: an even number of single quotes follows it.
OUTSIDE = r"(?=(?:[^']*'[^']*')*[^']*$)"


def _as_map(literal):
    for name, json in (("None", "null"), ("True", "true"), ("False", "false")):
        literal = F.regexp_replace(literal, rf"\b{name}\b{OUTSIDE}", json)
    parsed = F.from_json(literal, T.MapType(T.StringType(), T.StringType()))
    return F.when(F.coalesce(F.size(parsed) > 0, F.lit(False)), parsed)


def result_of_line(line: str, pattern: str = RESULT_LINE):
    """Result object printed in one log line; NULL if there is none or it can't be read."""
    return _as_map(F.nullif(F.regexp_extract(line, pattern, 1), F.lit("")))


def last_result(text: str, pattern: str = RESULT_LINE):
    """Last result object printed in a log text. Single quotes and None/True/False are accepted."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    parsed = F.filter(F.transform(found, _as_map), lambda m: m.isNotNull())
    return F.try_element_at(parsed, F.lit(-1))
