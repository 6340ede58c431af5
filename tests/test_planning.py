import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from noticeflow.operators import planning
from noticeflow.operators.calendar import day_spine
from noticeflow.operators.running import running_total
from noticeflow.plans.daily import collect_days
from noticeflow.operators.gates import GateError
from noticeflow.schema import REGIONS
from noticeflow.sinks import csv_row_bytes, current_snapshot, greedy_batches, size_bounded_batches

ITEMS = "plan string, date date, rank int, n long"
QUOTAS = "plan string, run_day date, balance int, daily_limit int"


def plan(spark, days, runs, **options):
    """days: {day: {region: n}}; runs: [(balance, limit)] -> (batches per run, statuses, skipped)."""
    items = [("p", d, REGIONS.index(r), n) for d, regions in days.items() for r, n in regions.items()]
    quotas = [("p", date(2026, 9, 10 + i), balance, limit) for i, (balance, limit) in enumerate(runs)]
    rows = planning.plan_quota_batches(spark.createDataFrame(items, ITEMS), spark.createDataFrame(quotas, QUOTAS), "plan", **options).collect()
    batches, statuses = {}, {}
    for r in sorted(rows, key=lambda r: (r["date"], r["rank"])):
        if r["outcome"] == "exported":
            batches.setdefault((r["run_day"].day - 10, r["batch"]), []).append((REGIONS[r["rank"]], r["n"]))
        if r["run_status"]:
            statuses[r["run_day"].day - 10] = r["run_status"]
    return [batches[k] for k in sorted(batches)], statuses, [REGIONS[r["rank"]] for r in rows if r["outcome"] == "skipped_oversize"]


DAY = date(2025, 1, 1)


def test_quota_cases(spark):
    assert plan(spark, {DAY: {"安徽": 120, "北京": 110}}, [(800, 200)]) == ([[("安徽", 120)]], {0: "waiting_quota"}, [])
    assert plan(spark, {DAY: {"安徽": 223}}, [(800, 200)]) == ([], {0: "needs_finer_split"}, [])
    assert plan(spark, {DAY: {"安徽": 223}}, [(150, 200)], finer_split_by_head=False) == ([], {0: "waiting_quota"}, [])
    assert plan(spark, {DAY: {"安徽": 300}, date(2025, 1, 2): {"北京": 500}}, [(800, 800), (800, 800)])[0] == [[("安徽", 300)], [("北京", 500)]]
    batches, statuses, _ = plan(spark, {DAY: {"北京": 400, "安徽": 300, "福建": 200}}, [(500, 800), (800, 800)])
    assert batches == [[("安徽", 300)], [("北京", 400), ("福建", 200)]] and statuses == {0: "waiting_quota", 1: "complete"}
    assert plan(spark, {DAY: {"安徽": 801, "北京": 800}}, [(800, 800)]) == ([[("北京", 800)]], {0: "complete_with_skips"}, ["安徽"])
    assert plan(spark, {DAY: {"安徽": 50}}, [(0, 800)]) == ([], {0: "waiting_quota"}, [])


def test_first_run_of_the_fold_equals_the_single_run_plan(spark):
    rng = random.Random(3)
    rows = [(p, date(2025, 1, 1 + d), r, rng.choice([0, 5, 40, 120, 900])) for p in "ab" for d in range(12) for r in range(9)]
    items = spark.createDataFrame(rows, ITEMS)
    quotas = spark.createDataFrame([(p, date(2026, 9, 10), 700, 800) for p in "ab"], QUOTAS)
    folded = planning.plan_quota_batches(items, quotas, "plan").where("outcome in ('exported', 'skipped_oversize')")
    single = planning.single_run_plan(items, "n", 700, ["date", "rank"], ["plan"]).where("outcome in ('exported', 'skipped_oversize')")
    columns = ["plan", "date", "rank", "outcome"]
    assert sorted(map(tuple, folded.select(columns).collect())) == sorted(map(tuple, single.select(columns).collect()))


@pytest.mark.parametrize("groups", [0, 2])
def test_running_total_is_exact_across_ranges_with_a_hot_group(spark, groups):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 5}", i, rng.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int, v long")
    group = ["g"] if groups else []
    result = running_total(df, "v", ["i"], group, partitions=6)
    totals, expected = {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        key = g if groups else None
        totals[key] = totals.get(key, 0) + v
        expected[i] = totals[key]
    assert {r["i"]: r["running"] for r in result.collect()} == expected


def test_size_bounded_batches_never_exceed_the_limit(spark):
    rng = random.Random(2)
    sizes = [(i, rng.randrange(1, 90)) for i in range(2000)]
    df = spark.createDataFrame(sizes, "i int, size long")
    result = sorted(size_bounded_batches(df, ["i"], "size", 90, 500, 20).collect(), key=lambda r: r["i"])
    assert [r["batch"] for r in result] == sorted(r["batch"] for r in result)
    held = {}
    for r in result:
        held[r["batch"]] = held.get(r["batch"], 20) + r["size"]
    assert max(held.values()) <= 500 and len(result) == len(sizes)
    with pytest.raises(ValueError):
        size_bounded_batches(df, ["i"], "size", 490, 500, 20)


def greedy_reference(sizes, limit, header):
    batches, used, number = {}, header, 0
    for i, size in sizes:
        if used + size > limit:
            number, used = number + 1, header
        used += size
        batches[i] = number
    return batches


def greedy_cuts(df, limit, header, **more):
    return {r["i"]: r["batch"] for r in greedy_batches(df, ["i"], "size", limit, header, **more).collect()}


@pytest.mark.parametrize("stretch,low,high", [(2, 1, 200), (3, 0, 5), (8, 0, 950), (10**6, 1, 200)])
def test_greedy_batches_are_those_of_one_pass(spark, stretch, low, high):
    rng = random.Random(stretch)
    sizes = [(i, rng.choice([low, rng.randrange(low, high)])) for i in range(1500)]
    df = spark.createDataFrame(sizes, "i int, size long").orderBy(F.rand(1))
    assert greedy_cuts(df, 1000, 50, stretch=stretch) == greedy_reference(sizes, 1000, 50)


@pytest.mark.parametrize("partitions", ["1", "3", "7"])
def test_greedy_cuts_do_not_follow_the_partitions(spark, partitions):
    sizes = [(i, 950 if i % 7 == 0 else (i * 37) % 480) for i in range(400)] + [(i, 0) for i in range(400, 420)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(sizes, "i int, size long").repartition(5)
        assert greedy_cuts(df, 1000, 50, stretch=2) == greedy_reference(sizes, 1000, 50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_greedy_batches_of_small_tables(spark):
    schema = "i int, size long"
    assert greedy_cuts(spark.createDataFrame([], schema), 1000, 50) == {}
    assert greedy_cuts(spark.createDataFrame([(1, 950)], schema), 1000, 50) == {1: 0}
    assert greedy_cuts(spark.createDataFrame([(1, 0), (2, 0)], schema), 1000, 50) == {1: 0, 2: 0}
    with pytest.raises(Exception, match="does not fit"):
        greedy_batches(spark.createDataFrame([(1, 951)], schema), ["i"], "size", 1000, 50).collect()


def test_csv_row_bytes_counts_utf8_and_quotes(spark):
    df = spark.createDataFrame([("标", 'a"b'), ("x", None)], "a string, b string")
    assert [r[0] for r in df.select(csv_row_bytes(["a", "b"])).collect()] == [len('标,"a""b"'.encode()) + 2, len("x,") + 2]


@pytest.mark.parametrize("national,regional,coverage,omitted", [(193, 192, "within_tolerance", 1), (193, 172, "error", None), (193, 193, "exact", 0), (190, 193, "within_tolerance", 0)])
def test_coverage_tolerance(spark, national, regional, coverage, omitted):
    day = spark.createDataFrame([("d", national)], "day string, n int")
    parts = spark.createDataFrame([("d", regional - 50), ("d", 50)], "day string, n int")
    row = planning.coverage_check(day, parts, "day", "n").first()
    assert (row["coverage"], row["omitted"]) == (coverage, omitted)
    assert planning.coverage_check(day, parts, "day", "n", 0).first()["coverage"] == ("exact" if national == regional else "error")


def test_quota_used(spark):
    batches = spark.createDataFrame([("d1", 120), ("d1", 80)], "quota_day string, count int")
    quotas = spark.createDataFrame([("d1", 700, 800), ("d2", 100, 800), ("d3", 800, 30)], "quota_day string, balance int, previous int")
    left = {r["quota_day"]: (r["used"], r["remaining"]) for r in planning.quota_used(batches, quotas, 400).collect()}
    assert left == {"d1": (200, 200), "d2": (0, 100), "d3": (0, 30)}


def test_daily_collect_resumes_and_rejects_bad_checkpoint(spark, tmp_path):
    criteria = F.struct(F.lit("全国").alias("region"), F.array(F.lit("b"), F.lit("a")).alias("keywords"),
                        F.array(F.lit("标题")).alias("match_methods"), F.array(F.lit("招标")).alias("notice_types"))
    notices = spark.createDataFrame([(date(2025, 1, 1),)] * 16 + [(date(2025, 1, 3),)], "day date")
    args = (f"{tmp_path}/cp", f"{tmp_path}/table", criteria)
    assert collect_days(spark, notices, "day", "2025-01-01", "2025-01-02", *args, started=False) == 2
    assert collect_days(spark, notices, "day", "2025-01-01", "2025-01-02", *args) == 0
    assert collect_days(spark, notices, "day", "2025-01-01", "2025-01-03", *args) == 1
    table = spark.read.option("header", True).csv(current_snapshot(spark, args[1]))
    assert sorted(map(tuple, table.collect())) == [("2025-01-01", "16"), ("2025-01-02", "0"), ("2025-01-03", "1")]
    bad = spark.read.json(args[0]).limit(1).withColumn("national_count", F.lit(-1))
    bad.write.mode("append").json(args[0])
    with pytest.raises(GateError):
        collect_days(spark, notices, "day", "2025-01-01", "2025-01-03", *args)


def test_spine_is_inclusive(spark):
    assert day_spine(spark, "2025-02-27", "2025-03-01").count() == 3
