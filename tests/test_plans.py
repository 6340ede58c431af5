"""Physical plans: no Python in SQL operators, pruned scans, map-side reduction."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bindings.common import table
from noticeflow.operators import compare, dedup, disposition, legacy
from noticeflow.plans.prepare import split_firsts, to_notices
from noticeflow.session import shared_dir
from noticeflow.sources import read_target

DATA = "/root/testdata/sf0.001"
PYTHON = {"read_workbooks", "audit_workbooks", "export_completeness", "sync_batch", "greedy_batches", "tag_records_in_calls"}
# These write and read files or run streams while they are built.
EAGER = {"sync_batch", "stream_upsert", "stream_first_wins", "stream_daily_counts", "load_csv_roundtrip",
         "collect_daily_counts", "read_summaries", "upsert_partitions", "sync_retry", "load_chunks", "read_logs", "scan_files", "load_summary", "outbox_status_counts", "tag_records", "tag_assignments",
         "stream_earliest_wins", "stream_outbox", "scan_workbooks"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted({name for area in entry.AREAS for name in area.Q} - PYTHON - EAGER))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, DATA))
    for operator in ("InPandas", "InArrow", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_first_wins_is_reduced_before_the_shuffle(spark):
    plan = plan_of(dedup.dedup_first(table(spark, DATA, "documents"), ["text"], ["doc_id"]))
    final, exchange, partial = (plan.index(s) for s in ("row_number(), 1, Final", "Exchange hashpartitioning", "row_number(), 1, Partial"))
    assert final < exchange < partial


def without_broadcast(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of(build())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffled_columns(plan):
    """Columns of the projection or scan right below each exchange of a plan."""
    lines = plan.split("\n")
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]


def test_disposition_counts_do_not_shuffle_bodies(spark):
    def build():
        docs = table(spark, DATA, "documents").withColumn("k", F.sha2("text", 256))
        labelled = disposition.with_disposition(docs, "k", ["doc_id"], F.col("lang") == "en", F.col("text").isNotNull(), F.length("text"), 100)
        return disposition.disposition_counts(labelled)

    plan = without_broadcast(spark, build)
    assert "SortMergeJoin" in plan and "Window" not in plan and "partial_min(doc_id" in plan
    assert not any("Project [doc_id" in line and "text#" in line.split(" AS ")[0] for line in shuffled_columns(plan))


def test_day_counts_of_written_rows_do_not_shuffle_bodies(spark):
    raw = spark.createDataFrame([("p", "f", 3, *["x"] * 33)], "_path string, _file string, _row int, " + ", ".join(f"c{i} string" for i in range(33)))
    folder = shared_dir(spark, "stage")
    to_notices(raw).write.parquet(folder)
    fits, _ = split_firsts(spark.read.parquet(folder))
    plan = plan_of(fits.groupBy("release_date__c").count())
    assert "Source_Content__c" not in plan and "content__c" not in plan and "_length" in plan


def test_compare_keys_is_one_aggregate_without_a_join(spark):
    plan = plan_of(compare.compare_keys(table(spark, DATA, "orders").select(F.col("o_orderkey").alias("k")),
                                        table(spark, DATA, "lineitem").select(F.col("l_orderkey").alias("k")), "k"))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_unique_index_combines_before_the_shuffle(spark):
    part = table(spark, DATA, "part").withColumn("key", F.col("p_partkey"))
    plan = plan_of(legacy.unique_index(part, "key", {"name": F.sha2("p_name", 256)}))
    assert "partial_min" in plan and "Expand" not in plan


def test_target_read_is_pruned_and_filtered(spark):
    plan = plan_of(read_target(spark, f"{DATA}/orders.parquet", ["o_orderkey"]).where("o_orderkey > 5"))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,5)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
