"""Stateful streams over several micro-batches."""

from datetime import datetime, timedelta

from noticeflow.sinks import read_table
from noticeflow.streaming import landing, state

START = datetime(2025, 1, 1)
SCHEMA = "k string, ts timestamp, n int"


def at(hours):
    return START + timedelta(hours=hours)


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def emitted(spark, tmp_path, batches, remember_hours):
    for rows in batches:
        land(spark, tmp_path / "in", rows)
    stream = landing.stream_landing(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    kept = state.stream_earliest_wins(stream, ["k"], "ts", ["n"], "2 hours", remember_hours * 3600)
    query = landing.write_table(kept, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    assert query.exception() is None
    out = spark.read.schema(SCHEMA).parquet(str(tmp_path / "out"))
    return sorted((r["k"], r["n"]) for r in out.collect()), out


def test_earliest_event_time_wins_and_late_copies_do_not_pass(spark, tmp_path):
    batches = [
        [("a", at(5), 1), ("a", at(5.5), 2), ("b", at(6), 3)],
        [("a", at(4.5), 4), ("b", at(6), 2)],          # earlier, and a tie, within the delay
        [("x", at(20), 5), ("a", at(19.5), 6)],         # the watermark passes a and b; a copy comes with it
        [("a", at(21), 7), ("x", at(20), 9), ("c", at(12), 8)],  # copies later than the delay; c is new and late
        [("y", at(40), 10)],
        [("a", at(41), 11)],
    ]
    got, out = emitted(spark, tmp_path, batches, 48)
    assert got == [("a", 4), ("b", 2), ("c", 8), ("x", 5)]
    rows = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    whole = {(r["k"], r["n"], r["closed"]) for r in state.with_held_rows(out, rows, ["k"], ["ts", "n"]).collect()}
    assert whole == {("a", 4, True), ("b", 2, True), ("x", 5, True), ("c", 8, True), ("y", 10, False)}


def test_forgotten_key_counts_as_new(spark, tmp_path):
    batches = [[("a", at(0), 1)], [("x", at(10), 2)], [("x", at(30), 3)], [("a", at(31), 4)], [("x", at(60), 5)], [("x", at(61), 6)]]
    assert emitted(spark, tmp_path, batches, 5)[0] == [("a", 1), ("a", 4), ("x", 2)]


def test_outbox_stream_keeps_the_first_content(spark, tmp_path):
    for rows in ([("m", at(0), 2), ("m", at(0), 1), ("o", at(0), 5)], [("m", at(1), 3), ("p", at(1), 4)]):
        land(spark, tmp_path / "in", rows)
    stream = landing.stream_landing(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    box, check = str(tmp_path / "box"), str(tmp_path / "check")
    landing.stream_outbox(stream, box, ["n"], check, "k").awaitTermination()
    again = spark.createDataFrame([("m", at(1), 3), ("q", at(1), 7)], SCHEMA)
    landing.append_alerts(again, 1, box, check, ["n"], "k")  # batch 1 is known, so nothing of it is added
    assert sorted((r["k"], r["n"], r["status"]) for r in read_table(spark, box, "k").collect()) == [
        ("m", 1, "pending"), ("o", 5, "pending"), ("p", 4, "pending")]
    landing.append_alerts(again, 2, box, check, ["n"], "k")
    assert sorted(r["k"] for r in read_table(spark, box, "k").collect()) == ["m", "o", "p", "q"]
