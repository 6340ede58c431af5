"""Structured Streaming queries over the event table, run to the end of the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeflow.functions import message_id
from noticeflow.session import shared_dir
from noticeflow.sinks import read_table
from noticeflow.streaming import landing, state

from .common import day, table

Q: dict = {}
SQL: dict = {}


def _events(spark, d):
    schema = table(spark, d, "events").schema
    return landing.stream_landing(spark, d, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _finished(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def latest_by_key(spark, d):
    base = shared_dir(spark, "stream")
    events = table(spark, d, "events").select(
        F.concat_ws(":", "event_type", "user_id").alias("key"), "event_type", "event_id",
        F.col("ts").cast("timestamp").alias("ts"), day("ts").alias("date"), "value")
    # Several files, each over the whole time: micro-batches bring newer and older rows of a key.
    events.repartition(2, "event_id").write.parquet(f"{base}/in")
    stream = landing.stream_landing(spark, f"{base}/in", events.schema, files_per_batch=1)
    _finished(landing.stream_upsert(stream, f"{base}/target", "key", ["ts", "event_id"], "date", f"{base}/checkpoint"))
    return read_table(spark, f"{base}/target", "key").select("key", "event_type", "event_id", "value")


Q["stream_upsert"] = latest_by_key
SQL["stream_upsert"] = """SELECT key, event_type, event_id, value FROM (SELECT event_type || ':' || user_id AS key, event_type, event_id, value,
 row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def first_wins(spark, d):
    base = shared_dir(spark, "stream")
    stream = _events(spark, d).withColumn("date", day("ts"))
    kept = landing.stream_first_wins(stream, ["user_id", "event_type", "date"], "ts", "1 day")
    _finished(landing.write_table(kept.select("user_id", "event_type", "date"), f"{base}/out", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/out")


Q["stream_first_wins"] = first_wins
SQL["stream_first_wins"] = "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS date FROM events"


def daily(spark, d):
    base = shared_dir(spark, "stream")
    counts = landing.stream_daily_counts(_events(spark, d), "ts", "1 hour", ["event_type"])
    _finished(landing.write_table(counts, f"{base}/out", f"{base}/checkpoint"))
    return landing.with_open_days(spark.read.parquet(f"{base}/out"), table(spark, d, "events"), "ts", ["event_type"])


Q["stream_daily_counts"] = daily
SQL["stream_daily_counts"] = """SELECT date, event_type, count(*) AS n,
 date + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) AS closed
 FROM (SELECT CAST(ts AS DATE) AS date, event_type FROM events) GROUP BY date, event_type"""


def _landed(spark, base, rows, parts):
    """The rows as files that a stream takes one by one, in the order of ``parts``."""
    for part in parts:
        rows.where(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(f"{base}/in")
    return landing.stream_landing(spark, f"{base}/in", rows.drop("_part").schema, files_per_batch=1)


def earliest_wins(spark, d):
    """Events land a third of the time range at a time, but clicks a day early or late: the earliest of a user and type stays."""
    base = shared_dir(spark, "stream")
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    moved = F.when(F.col("event_type") == "click", F.when(F.col("event_id") % 2 == 0, 86_400).otherwise(-86_400)).otherwise(0)
    share = (F.unix_timestamp("ts") + moved - F.unix_timestamp(F.lit(first))) / ((last - first).total_seconds() / 3)
    rows = events.withColumn("_part", F.least(F.lit(2), F.greatest(F.lit(0), F.floor(share))).cast("int"))
    stream = _landed(spark, base, rows, range(3))
    key, order = ["user_id", "event_type"], ["ts", "event_id"]
    kept = state.stream_earliest_wins(stream, key, "ts", ["event_id"], "3 days", 60 * 86_400)
    _finished(landing.write_table(kept, f"{base}/out", f"{base}/checkpoint"))
    emitted = spark.read.schema(events.schema).parquet(f"{base}/out")
    return state.with_held_rows(emitted, events, key, order).select("user_id", "event_type", "event_id")


Q["stream_earliest_wins"] = earliest_wins
SQL["stream_earliest_wins"] = "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL"


def outbox_of_stream(spark, d):
    """Alerts in two micro-batches, the second of which is run again: one message per user and type."""
    base = shared_dir(spark, "stream")
    none = F.array().cast("array<string>")
    alerts = table(spark, d, "events").select(
        "event_id", "event_type", "user_id", message_id(F.concat_ws("/", "event_type", "user_id"), "event_type", "event_type", none).alias("id"),
        (F.col("event_id") % 2).cast("int").alias("_part"))
    box, checkpoint = f"{base}/outbox", f"{base}/checkpoint"
    _finished(landing.stream_outbox(_landed(spark, base, alerts, (1, 0)), box, ["event_id"], checkpoint))
    landing.append_alerts(alerts.where("_part = 0").drop("_part"), 1, box, checkpoint, ["event_id"])
    return read_table(spark, box, "id").select("event_id", "event_type", "user_id", "status")


Q["stream_outbox"] = outbox_of_stream
SQL["stream_outbox"] = """SELECT arg_min(event_id, (1 - event_id % 2, event_id)) AS event_id, event_type, user_id, 'pending' AS status
FROM events GROUP BY event_type, user_id"""
