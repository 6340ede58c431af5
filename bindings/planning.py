"""Calendar, quota planning, coverage and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeflow.operators import calendar, gates, planning
from noticeflow.plans.daily import collect_days
from noticeflow.schema import CRITERIA_TYPE
from noticeflow.session import shared_dir
from noticeflow.sinks import current_snapshot
from noticeflow.sources import read_checkpoint

from .common import day, event_number, table

Q: dict = {}
SQL: dict = {}


def _orders(spark, d):
    return table(spark, d, "orders").withColumn("date", day("o_orderdate"))


Q["daily_counts"] = lambda spark, d: calendar.daily_counts(
    _orders(spark, d), "date", calendar.spine_of(_orders(spark, d), "date"))
SQL["daily_counts"] = """
WITH s AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders),
 c AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
SELECT date, coalesce(n, 0) AS national_count FROM s LEFT JOIN c USING (date)"""

Q["missing_dates"] = lambda spark, d: calendar.missing_dates(
    calendar.spine_of(_orders(spark, d), "date"), _orders(spark, d).where("o_orderstatus = 'P'"))
SQL["missing_dates"] = """
SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders
EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P'"""


def _criteria(region="全国"):
    return F.struct(F.lit(region).alias("region"), F.array(F.lit("a"), F.lit("b")).alias("keywords"),
                    F.array(F.lit("标题")).alias("match_methods"), F.array(F.lit("招标"), F.lit("中标")).alias("notice_types"))


def collect_daily(spark, d):
    """Count the event days in two runs; the second run only adds what the first left."""
    base = shared_dir(spark, "daily")
    events = table(spark, d, "events").select(day("ts").alias("date"))
    args = (f"{base}/checkpoint", f"{base}/table", _criteria())
    low, middle, high = map(str, events.agg(
        F.min("date"), F.date_add(F.min("date"), 19), F.max("date")).first())
    first = collect_days(spark, events, "date", low, middle, *args, started=False)
    second = collect_days(spark, events, "date", low, high, *args)
    held = read_checkpoint(spark, args[0]).select("date", F.col("national_count").alias("held"))
    written = spark.read.schema("date date, national_count bigint").option("header", True).csv(current_snapshot(spark, args[1]))
    return written.join(held, "date", "full").select(
        "date", "national_count", "held", F.lit(first).alias("first_run"), F.lit(second).alias("second_run"))


Q["collect_daily_counts"] = collect_daily
SQL["collect_daily_counts"] = """
WITH s AS (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date FROM events),
 c AS (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1)
SELECT date, coalesce(n, 0) AS national_count, coalesce(n, 0) AS held, 20 AS first_run, CAST((SELECT count(*) FROM s) - 20 AS INTEGER) AS second_run
FROM s LEFT JOIN c USING (date)"""


def checkpoint_check(spark, d):
    """Event days as checkpoint rows: three types repeat their days, one has other criteria."""
    events = table(spark, d, "events")
    counts = events.groupBy(day("ts").alias("date"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min(event_number()).alias("low"))
    rows = counts.select(
        F.when(F.col("event_type") == "click", F.add_months("date", 12)).otherwise(
            F.when(F.col("event_type") == "signup", F.add_months("date", 24)).otherwise(F.col("date"))).alias("date"),
        F.when(F.col("event_type") == "click", F.col("low") - 1).otherwise(F.col("n")).alias("national_count"),
        F.when(F.col("event_type") == "signup", _criteria("北京")).otherwise(_criteria()).cast(CRITERIA_TYPE).alias("criteria"))
    return gates.checkpoint_valid(rows, _criteria())


Q["checkpoint_valid"] = checkpoint_check
SQL["checkpoint_valid"] = """
WITH c AS (SELECT CAST(ts AS DATE) AS date, event_type, min(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS low
 FROM events GROUP BY ALL)
SELECT CAST(date + INTERVAL 12 MONTH AS DATE) AS date, 'count' AS problem FROM c WHERE event_type = 'click' AND low < 1
UNION ALL SELECT CAST(date + INTERVAL 24 MONTH AS DATE), 'criteria' FROM c WHERE event_type = 'signup'
UNION ALL SELECT date, 'repeated' FROM c WHERE event_type NOT IN ('click', 'signup') GROUP BY date HAVING count(*) > 1"""


def _counts(spark, d):
    """Orders per region (plan), month and nation (rank within the month)."""
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    monthly = (_orders(spark, d).join(customers, F.col("o_custkey") == F.col("c_custkey"))
               .groupBy(F.trunc("date", "month").alias("date"), F.col("c_nationkey").alias("rank"))
               .agg(F.count(F.lit(1)).alias("n")))
    return monthly.join(nations, F.col("rank") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("plan"), "date", "rank", "n")


_ITEMS = """
WITH items AS (SELECT n_regionkey AS plan, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, c_nationkey AS rank, count(*) AS n
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
"""
BUDGET, OVERSIZE = 400, 12
ORDER = ["date", "rank"]
Q["prefix_within_budget"] = lambda spark, d: planning.prefix_within_budget(
    _counts(spark, d), "n", BUDGET, ORDER, ["plan"])
SQL["prefix_within_budget"] = _ITEMS + f"""
r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY plan ORDER BY date, rank ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM items)
SELECT plan, date, rank, n, running FROM r WHERE running <= {BUDGET}"""

Q["single_run_plan"] = lambda spark, d: planning.single_run_plan(
    _counts(spark, d), "n", BUDGET, ORDER, ["plan"], OVERSIZE)
_PLAN = _ITEMS + f"""
r AS (SELECT *, CASE WHEN n <= {OVERSIZE} THEN n ELSE 0 END AS take,
  CAST(sum(CASE WHEN n <= {OVERSIZE} THEN n ELSE 0 END) OVER (PARTITION BY plan ORDER BY date, rank ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM items),
p AS (SELECT plan, date, rank, n, running, CASE WHEN n > {OVERSIZE} AND running - take < {BUDGET} THEN 'skipped_oversize'
  WHEN n <= {OVERSIZE} AND running <= {BUDGET} THEN 'exported' ELSE 'waiting' END AS outcome FROM r)
"""
SQL["single_run_plan"] = _PLAN + "SELECT * FROM p"

Q["oversize_skips"] = lambda spark, d: planning.oversize_skips(
    _counts(spark, d), "n", BUDGET, ORDER, ["plan"], OVERSIZE)
SQL["oversize_skips"] = _PLAN + f"""SELECT plan, date, rank, n, 'province_over_daily_limit' AS reason, {OVERSIZE} AS "limit" FROM p WHERE outcome = 'skipped_oversize'"""


def used(spark, d):
    batches = (_orders(spark, d).groupBy(F.col("date").alias("quota_day"), "o_orderpriority")
               .agg(F.count(F.lit(1)).alias("count")))
    quotas = (table(spark, d, "lineitem").groupBy(day("l_shipdate").alias("quota_day"))
              .agg(F.count(F.lit(1)).alias("balance"), F.lit(40).alias("previous")))
    return planning.quota_used(batches, quotas, 10)


Q["quota_used"] = used
SQL["quota_used"] = """
WITH u AS (SELECT CAST(o_orderdate AS DATE) AS quota_day, count(*) AS used FROM orders GROUP BY 1),
 q AS (SELECT CAST(l_shipdate AS DATE) AS quota_day, count(*) AS balance FROM lineitem GROUP BY 1)
SELECT quota_day, coalesce(used, 0) AS used, least(balance, greatest(0, 10 - coalesce(used, 0)), 40) AS remaining FROM q LEFT JOIN u USING (quota_day)"""


def coverage(spark, d):
    solvent = table(spark, d, "customer").where("c_acctbal >= 0").select("c_custkey", "c_nationkey")
    monthly = _orders(spark, d).withColumn("month", F.trunc("date", "month"))
    national = monthly.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    regional = (monthly.join(solvent, F.col("o_custkey") == F.col("c_custkey"))
                .groupBy("month", "c_nationkey").agg(F.count(F.lit(1)).alias("n")))
    return planning.coverage_check(national, regional, "month", "n")


Q["coverage_check"] = coverage
SQL["coverage_check"] = """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, c_acctbal >= 0 AS solvent FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
 t AS (SELECT month, count(*) AS national_count, count(*) FILTER (solvent) AS region_count FROM o GROUP BY 1)
SELECT *, national_count - region_count AS difference, CASE WHEN national_count = region_count THEN 'exact'
 WHEN abs(national_count - region_count) <= 20 THEN 'within_tolerance' ELSE 'error' END AS coverage,
 CASE WHEN abs(national_count - region_count) <= 20 THEN greatest(national_count - region_count, 0) END AS omitted FROM t"""


def spread(spark, d):
    hourly = table(spark, d, "events").groupBy(
        day("ts").alias("date"), "event_type", F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return planning.spread_tolerant_max(hourly, ["date", "event_type"], "n", 6)


Q["spread_tolerant_max"] = spread
SQL["spread_tolerant_max"] = """
WITH h AS (SELECT CAST(ts AS DATE) AS date, event_type, hour(ts) AS h, count(*) AS n FROM events GROUP BY ALL),
 g AS (SELECT date, event_type, max(n) AS hi, min(n) AS lo FROM h GROUP BY ALL)
SELECT date, event_type, CASE WHEN hi - lo <= 6 THEN hi END AS value, hi - lo AS spread, hi - lo > 6 AS error FROM g"""


def drift(spark, d):
    readings = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_linestatus") == "F").alias("first"), F.count_if(F.col("l_linestatus") == "O").alias("again"),
        F.count_if(F.col("l_returnflag") != "A").alias("remaining"))
    return planning.count_drift(readings, ["l_suppkey"], "first", "again", "remaining")


Q["count_drift"] = drift
SQL["count_drift"] = """
WITH r AS (SELECT l_suppkey, count(*) FILTER (l_linestatus = 'F') AS first, count(*) FILTER (l_linestatus = 'O') AS again,
 count(*) FILTER (l_returnflag <> 'A') AS left_over FROM lineitem GROUP BY 1)
SELECT l_suppkey, first, again, abs(again - first) AS drift, CASE WHEN abs(again - first) > 20 THEN 'drift' WHEN again > left_over THEN 'over_quota' ELSE 'ok' END AS decision,
 CASE WHEN abs(again - first) <= 20 AND again <= left_over THEN again END AS adopted FROM r"""

Q["region_list_check"] = lambda spark, d: planning.region_list_check(table(spark, d, "supplier").withColumn(
    "bucket", F.floor(F.col("s_acctbal") / 1000)), "bucket", "s_nationkey")
SQL["region_list_check"] = """SELECT CAST(floor(s_acctbal / 1000) AS BIGINT) AS bucket, count(*) AS listed, count(DISTINCT s_nationkey) AS distinct_regions,
 count(*) = count(DISTINCT s_nationkey) AS valid FROM supplier GROUP BY 1"""

Q["region_list_valid"] = lambda spark, d: gates.region_list_valid(table(spark, d, "supplier"), "s_nationkey")
SQL["region_list_valid"] = """SELECT count(*) AS listed, count(DISTINCT s_nationkey) AS distinct_regions,
 count(*) > 0 AND count(*) = count(DISTINCT s_nationkey) AS valid FROM supplier"""


def broken_quota(spark, d):
    orders = table(spark, d, "events").select(
        "event_id", event_number().alias("taken"), (F.col("user_id") + 50).alias("balance"),
        (F.col("user_id") + 50 - event_number() + F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("remaining"),
        F.when(F.col("event_type") == "signup", F.col("value")).otherwise(0.0).alias("fee"))
    return gates.quota_invariant(orders, "taken", "balance", "remaining", "fee").select("event_id", "taken", "balance")


Q["quota_invariant"] = broken_quota
SQL["quota_invariant"] = """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS taken, user_id + 50 AS balance, event_type, value FROM events)
SELECT event_id, taken, balance FROM e WHERE NOT (taken > 0 AND taken <= least(800, balance) AND event_type <> 'error'
 AND (event_type <> 'signup' OR value = 0))"""
