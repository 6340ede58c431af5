"""Budgeted batch planning over ordered (day, region) counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import COUNT_TOLERANCE, HARD_LIMIT
from .running import running_total


def quota_used(batches: DataFrame, quotas: DataFrame, daily_limit: int = HARD_LIMIT) -> DataFrame:
    """Per quota day: rows used and rows left = min(balance, limit - used, previous)."""
    used = batches.groupBy("quota_day").agg(F.sum("count").cast("bigint").alias("used"))
    joined = quotas.join(used, "quota_day", "left").withColumn(
        "used", F.coalesce("used", F.lit(0).cast("bigint")))
    allowance = F.greatest(F.lit(0).cast("bigint"), F.lit(daily_limit).cast("bigint") - F.col("used"))
    left = F.least(F.col("balance").cast("bigint"), allowance, F.col("previous").cast("bigint"))
    return joined.select("quota_day", "used", left.alias("remaining"))


def prefix_within_budget(items: DataFrame, value: str, budget: int, order: Sequence[str],
                         group: Sequence[str] = ()) -> DataFrame:
    """Longest leading run of items whose total stays within the budget; none is skipped to fill.

    Values are not negative, so running totals only grow and a comparison is exact.
    """
    totals = running_total(items, value, order, group)
    return totals.where(F.col("running") <= budget)


def single_run_plan(items: DataFrame, value: str, budget: int, order: Sequence[str],
                    group: Sequence[str] = (), hard_limit: int = HARD_LIMIT) -> DataFrame:
    """Outcome of one planning run for every item of a plan.

    exported: running total of ordinary items fits. skipped_oversize: above the
    hard limit and reached while quota was left. zero: nothing to export.
    waiting: everything after the first item that did not fit.
    """
    ordinary = items.withColumn("_take", F.when(F.col(value) <= hard_limit, F.col(value)).otherwise(0))
    totals = running_total(ordinary, "_take", order, group)
    before = F.col("running") - F.col("_take")
    outcome = (
        F.when(F.col(value) == 0, "zero")
        .when(F.col(value) > hard_limit, F.when(before < budget, "skipped_oversize").otherwise("waiting"))
        .when(F.col("running") <= budget, "exported").otherwise("waiting"))
    return totals.withColumn("outcome", outcome).drop("_take")


def oversize_skips(items: DataFrame, value: str, budget: int, order: Sequence[str],
                   group: Sequence[str] = (), hard_limit: int = HARD_LIMIT) -> DataFrame:
    """Skip records: items above the hard limit that a run reaches with quota left."""
    plan = single_run_plan(items, value, budget, order, group, hard_limit)
    return plan.where("outcome = 'skipped_oversize'").select(
        *group, *order, value, F.lit("province_over_daily_limit").alias("reason"),
        F.lit(hard_limit).alias("limit"))


FOLD_COLUMNS = ["date", "rank", "n", "run_day", "batch", "outcome", "remaining", "run_status"]
PLAN_OUTPUT = ("date date, rank int, n bigint, run_day date, batch int, outcome string, "
               "remaining bigint, run_status string")


def _fold(items: pd.DataFrame, quotas: list[tuple], hard_limit: int, by_head: bool) -> Iterator[dict]:
    """Walk one plan's items through its run days. Small: days x regions rows."""
    rows = items[["date", "rank", "n"]].sort_values(["date", "rank"]).to_dict("records")
    by_day: dict = {}
    for row in rows:
        by_day.setdefault(row["date"], []).append(row)
    queue = [row for day in sorted(by_day) for row in by_day[day]]
    # A day is exported whole only while none of its regions was taken yet.
    position, batch, skipped = 0, 0, False
    results = [dict(row, run_day=None, batch=None, outcome="waiting", remaining=None, run_status=None)
               for row in queue]
    for run_day, balance, limit in quotas:
        left, status, first = min(balance, limit), None, position
        while position < len(queue):
            head = queue[position]["n"]
            if left == 0:
                status = "waiting_quota"
                break
            if head == 0:
                results[position].update(outcome="zero", run_day=run_day)
                position += 1
                continue
            if head > hard_limit:
                results[position].update(outcome="skipped_oversize", run_day=run_day, remaining=left)
                position, skipped = position + 1, True
                continue
            if head > left:
                too_big = head > limit if by_head else left >= limit
                status = "needs_finer_split" if too_big else "waiting_quota"
                break
            batch += 1
            day = queue[position]["date"]
            while (position < len(queue) and queue[position]["date"] == day
                   and queue[position]["n"] <= left and queue[position]["n"] <= hard_limit):
                left -= queue[position]["n"]
                taken = queue[position]["n"] > 0
                results[position].update(outcome="exported" if taken else "zero", run_day=run_day,
                                         batch=batch if taken else None, remaining=left)
                position += 1
        status = status or ("complete_with_skips" if skipped else "complete")
        for row in results[first:position]:
            row["run_status"] = status
        if position < len(queue) and first == position:
            # Nothing moved: show why at the head of the queue.
            results[position].update(run_day=run_day, run_status=status, remaining=left)
        if position == len(queue):
            break
    yield from results


def plan_quota_batches(items: DataFrame, quotas: DataFrame, group: str, hard_limit: int = HARD_LIMIT,
                       finer_split_by_head: bool = True) -> DataFrame:
    """Multi-day plan: what each run day exports from where the last one stopped.

    ``items``: (group, date, rank, n); ``quotas``: (group, run_day, balance,
    daily_limit). Each run depends on the one before, so a plan is folded in one
    group; a plan is days x 34 regions rows whatever the data size, and plans
    run in parallel. A head that does not fit asks for a finer split when it is
    above the daily limit, or, with ``finer_split_by_head=False``, when the whole
    daily limit was still free.
    """
    kind = items.schema[group].dataType.simpleString()

    def fold(key: tuple, rows: pd.DataFrame, budgets: pd.DataFrame) -> pd.DataFrame:
        runs = [(q.run_day, int(q.balance), int(q.daily_limit))
                for q in budgets.sort_values("run_day").itertuples(index=False)]
        plan = pd.DataFrame(list(_fold(rows, runs, hard_limit, finer_split_by_head)), columns=FOLD_COLUMNS)
        plan["batch"] = plan["batch"].astype("Int32")
        plan["remaining"] = plan["remaining"].astype("Int64")
        plan.insert(0, group, key[0])
        return plan

    ordered = items.select(group, "date", "rank", "n").groupBy(group)
    budgets = quotas.select(group, "run_day", "balance", "daily_limit").groupBy(group)
    return ordered.cogroup(budgets).applyInPandas(fold, f"{group} {kind}, {PLAN_OUTPUT}")


def coverage_check(national: DataFrame, regional: DataFrame, day: str, value: str,
                   tolerance: int = COUNT_TOLERANCE) -> DataFrame:
    """Per day: national total against the sum of its regions.

    ok within the tolerance (0 demands equality); a positive gap is recorded as
    omitted. Days present on one side only compare with zero.
    """
    sides = (national.select(day, F.col(value).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
             .unionByName(regional.select(day, F.lit(0).cast("bigint").alias("a"), F.col(value).cast("bigint").alias("b"))))
    totals = sides.groupBy(day).agg(F.sum("a").alias("national_count"), F.sum("b").alias("region_count"))
    gap = F.col("national_count") - F.col("region_count")
    return totals.select(
        day, "national_count", "region_count", gap.alias("difference"),
        F.when(gap == 0, "exact").when(F.abs(gap) <= tolerance, "within_tolerance").otherwise("error").alias("coverage"),
        F.when(F.abs(gap) <= tolerance, F.greatest(gap, F.lit(0).cast("bigint"))).alias("omitted"))


def spread_tolerant_max(readings: DataFrame, group: Sequence[str], value: str,
                        tolerance: int = COUNT_TOLERANCE) -> DataFrame:
    """Largest of repeated readings per group; an error where they differ too much."""
    spread = readings.groupBy(*group).agg(F.max(value).alias("_high"), F.min(value).alias("_low"))
    ok = F.col("_high") - F.col("_low") <= tolerance
    return spread.select(*group, F.when(ok, F.col("_high")).alias("value"),
                         (F.col("_high") - F.col("_low")).alias("spread"), (~ok).alias("error"))


def count_drift(readings: DataFrame, key: Sequence[str], first: str, again: str, remaining: str,
                tolerance: int = COUNT_TOLERANCE) -> DataFrame:
    """Re-read counts: adopt a small change, stop on a large one or beyond the quota left."""
    drift = F.abs(F.col(again) - F.col(first))
    return readings.select(
        *key, first, again, drift.alias("drift"),
        F.when(drift > tolerance, "drift").when(F.col(again) > F.col(remaining), "over_quota")
        .otherwise("ok").alias("decision"),
        F.when((drift <= tolerance) & (F.col(again) <= F.col(remaining)), F.col(again)).alias("adopted"))


def region_list_check(regions: DataFrame, day: str, region: str) -> DataFrame:
    """Per day: listed regions, distinct regions, and whether the list is usable."""
    per_region = regions.groupBy(day, region).agg(F.count(F.lit(1)).alias("n"))
    counts = per_region.groupBy(day).agg(F.sum("n").alias("listed"), F.count(F.lit(1)).alias("distinct_regions"))
    return counts.withColumn("valid", (F.col("listed") > 0) & (F.col("listed") == F.col("distinct_regions")))

