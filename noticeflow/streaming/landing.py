"""Structured Streaming forms of the load, the first-wins filter and the daily counts.

A file stream remembers paths, not content, so an edited file is not seen
again: use the batch load for workbooks and these for append-only landings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_last
from ..operators.outbox import PENDING, outbox_dedupe
from ..sinks.upsert import read_table, upsert_table


def stream_landing(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
                   fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Append-only folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def stream_upsert(stream: DataFrame, target: str, key: str, order: Sequence[str], cluster: str,
                  checkpoint: str, compact_after: int = 50) -> StreamingQuery:
    """Upsert each micro-batch by key as one load; read with ``sinks.read_table``.

    The row with the highest ``order`` stays, whatever the batch it comes in. A batch reads nothing of the
    table; beyond ``compact_after`` loads they are folded into a snapshot. A replayed batch is recognised by its number
    and not added again.
    """
    def apply(batch: DataFrame, number: int) -> None:
        upsert_table(batch.sparkSession, target, dedup_last(batch, [key], order), key, cluster, order,
                     overwrite_with_null=True, count_inserted=False, applied=(checkpoint, number), compact_after=compact_after)

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def append_alerts(alerts: DataFrame, number: int, outbox: str, stream: str, order: Sequence[str], message: str = "id") -> dict:
    """Add the alerts of one micro-batch whose id the stored outbox lacks, as pending messages.

    The first content of an id stays. A batch of the same ``stream`` and ``number`` adds nothing again.
    """
    held = read_table(alerts.sparkSession, outbox, message)
    known = alerts.select(message, F.lit(PENDING).alias("status")).limit(0) if held is None else held.select(message, "status")
    new = outbox_dedupe(alerts, known, order, message).withColumn("status", F.lit(PENDING))
    return upsert_table(alerts.sparkSession, outbox, new, message, message, count_inserted=False, applied=(stream, number),
                        compact_after=50)


def stream_outbox(alerts: DataFrame, outbox: str, order: Sequence[str], checkpoint: str, message: str = "id") -> StreamingQuery:
    """Deduplicate a stream of alerts against the stored outbox, by an anti join in each micro-batch; read with ``sinks.read_table``."""
    def apply(batch: DataFrame, number: int) -> None:
        append_alerts(batch, number, outbox, checkpoint, order, message)

    return (alerts.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_first_wins(stream: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Keep the first arriving row of a key for as long as the watermark delay.

    Weaker than the batch first-wins: arrival order counts, and a copy later
    than the delay passes; ``state.stream_earliest_wins`` has neither. State is bounded by the delay, all in the JVM.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def stream_daily_counts(stream: DataFrame, ts: str, delay: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per day, emitted when the watermark passes the day (an extension of the batch count)."""
    window = F.window(ts, "1 day")
    return (stream.withWatermark(ts, delay).groupBy(window.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("date").alias("date"), *by, "n"))


def with_open_days(closed: DataFrame, rows: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """All days with a flag ``closed``: those the stream has emitted, and batch counts of the days after them.

    A run that ends leaves its last days open; their numbers may still grow.
    """
    last = closed.agg(F.max("date").alias("m")).scalar()
    later = rows.select(F.col(ts).cast("date").alias("date"), *by).where(last.isNull() | (F.col("date") > last))
    return closed.withColumn("closed", F.lit(True)).unionByName(
        later.groupBy("date", *by).agg(F.count(F.lit(1)).alias("n")).withColumn("closed", F.lit(False)))


def write_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run what is available into a parquet folder."""
    return (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
