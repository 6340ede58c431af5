"""Run summaries and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import count_value, run_status
from ..functions.text import is_blank
from ..schema import (DOWNLOAD_UPLOAD_SUCCESS, LOAD_SUCCESS, STATUS_FAILED, STATUS_OK)
from .dedup import dedup_last

NO_FILES = "本次无新增文件"


def export_completeness(batches: DataFrame, audits: DataFrame, file: str, expected: str,
                        audit_path: str = "path") -> DataFrame:
    """Each batch against its file: the file must have expected + 1 rows (header included)."""
    seen = audits.select(F.col(audit_path).alias(file), F.col("ok").alias("_ok"), F.col("rows").alias("file_rows"))
    state = (F.when(F.col("_ok").isNull(), "missing").when(~F.col("_ok"), "corrupt")
             .when(F.col("file_rows") == F.col(expected) + 1, "complete").otherwise("mismatch"))
    return batches.join(seen, file, "left").withColumn("state", state).drop("_ok")


def run_summary(batches: DataFrame, audits: DataFrame, quota_day: str, day: str, count: str, file: str,
                audit_path: str = "path") -> DataFrame:
    """Per quota day: batches, rows, day range, verified rows, invalid files, local status."""
    valid = audits.select(F.col(audit_path).alias(file), F.col("ok").alias("_ok"))
    checked = batches.join(valid, file, "left").withColumn("_ok", F.coalesce("_ok", F.lit(False)))
    per_day = checked.groupBy(quota_day).agg(
        F.count(F.lit(1)).alias("batches"), F.sum(count).cast("bigint").alias("rows"),
        F.count_distinct(day).alias("completed_dates"),
        F.min(day).alias("completed_date_start"), F.max(day).alias("completed_date_end"),
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col(count))), F.lit(0)).cast("bigint").alias("local_verified_rows"),
        F.count_if(~F.col("_ok")).alias("invalid_files"))
    return per_day.withColumn("local_status", local_status("batches", "invalid_files"))


def local_status(batches: str, invalid_files: str) -> Column:
    return (F.when(F.col(invalid_files) > 0, STATUS_FAILED).when(F.col(batches) > 0, STATUS_OK)
            .otherwise(NO_FILES))


def download_upload_ok(status: str) -> Column:
    """Upload states that a download run accepts; narrower than a load run's own."""
    return F.coalesce(F.col(status).isin(*DOWNLOAD_UPLOAD_SUCCESS), F.lit(False))


def upload_summary(runs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per load run: attempted, successful, failed, blocked, inserted, updated, filtered, status.

    ``runs`` has status, rows, attempted_rows, failed_rows, blocked_rows,
    inserted_rows, updated_rows, duplicates_filtered and categories_filtered
    (a map of counts by category).
    """
    good = F.coalesce(F.col("status").isin(*LOAD_SUCCESS), F.lit(False))

    def number(name):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))

    return runs.select(
        *keep, run_status("status", "blocked_rows").alias("final_status"),
        number("attempted_rows").alias("attempted_rows"),
        F.when(good, number("rows")).otherwise(0).alias("successful_rows"),
        number("failed_rows").alias("failed_rows"), number("blocked_rows").alias("blocked_rows"),
        F.col("inserted_rows").cast("bigint").alias("inserted_rows"),
        F.col("updated_rows").cast("bigint").alias("updated_rows"),
        number("duplicates_filtered").alias("duplicates_filtered"),
        count_value(by_name="categories_filtered").alias("categories_filtered"))


# Fixed values of the run summaries.
LOAD_AWAITED, NO_LOAD_RESULT, BAD_FILES = "等待独立上传任务", "未取得 Salesforce 同步成功结果", "以下本地文件缺失或损坏"


def _whole(value: Column) -> Column:
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def load_summary(runs: DataFrame, reports: DataFrame, results: DataFrame, run: str) -> DataFrame:
    """One row per run from its parts: the prepare report and the result that the load logged.

    ``reports``: (run, source_files, rows_read, rows_written, blocked_rows), at most one row per run;
    ``results``: (run, result), a map as ``read_logs`` gives it. A part that is
    missing leaves its numbers NULL or zero; blocked rows fall back to the report.
    """
    parts = (runs.select(run).join(reports.withColumnRenamed("blocked_rows", "_blocked"), run, "left")
             .join(results.select(run, "result"), run, "left"))

    def said(name: str) -> Column:
        return F.try_element_at(F.col("result"), F.lit(name))

    good = F.coalesce(said("status").isin(*LOAD_SUCCESS), F.lit(False))
    logged = _whole(said("blocked_rows"))
    blocked = F.when(logged > 0, logged).otherwise(_whole(F.col("_blocked")))
    return parts.select(
        run, run_status(said("status"), blocked).alias("final_status"),
        F.col("source_files").alias("files"), "rows_read", F.col("rows_written").alias("attempted_rows"),
        F.when(good, F.coalesce(said("successful_rows").try_cast("bigint"), _whole(said("rows")))).otherwise(0).alias("successful_rows"),
        _whole(said("failed_rows")).alias("failed_rows"), blocked.alias("blocked_rows"),
        said("inserted_rows").try_cast("bigint").alias("inserted_rows"),
        said("updated_rows").try_cast("bigint").alias("updated_rows"),
        _whole(said("duplicates_filtered")).alias("duplicates_filtered"), F.when(good, said("job_id")).alias("job_id"))


def with_upload(summaries: DataFrame, results: DataFrame, run: str, expected: bool = True) -> DataFrame:
    """Download summaries (``run_summary``) with the state of their upload and an overall status.

    Only some results count as an upload here (``download_upload_ok``). ``expected`` says whether
    a run without one has failed or waits for the separate load.
    """
    joined = summaries.join(results.select(run, F.try_element_at("result", F.lit("status")).alias("_status"),
                                           F.try_element_at("result", F.lit("rows")).alias("_rows")), run, "left")
    good, bad = download_upload_ok("_status"), F.col("invalid_files") > 0
    missing = F.lit(expected) & ~good
    reason = F.when(bad, BAD_FILES).when(missing, NO_LOAD_RESULT).otherwise("")
    return joined.select(
        *summaries.columns, F.when(good, STATUS_OK).otherwise(STATUS_FAILED if expected else LOAD_AWAITED).alias("upload_status"),
        F.when(good, _whole(F.col("_rows"))).otherwise(0).alias("uploaded_rows"),
        F.when(bad | missing, STATUS_FAILED).otherwise(STATUS_OK).alias("overall_status"), reason.alias("reason"))


def daily_report(runs: DataFrame, day: str, kind: str, status: str, modified: str, rows: str,
                 kinds: tuple[str, str, str], tiebreak: str, ok: str = STATUS_OK) -> DataFrame:
    """One row per day from the newest run of each of three kinds.

    All three must carry exactly the ok status; partial success is not success.
    One aggregate picks the three newest runs together.
    """
    newest = F.struct(F.col(modified).alias("m"), F.col(tiebreak).alias("t"),
                      F.col(status).alias("status"), F.col(rows).alias("rows"))
    names = ["download", "sandbox", "production"]
    picked = runs.where(F.col(kind).isin(*kinds)).groupBy(day).agg(
        *[F.max(F.when(F.col(kind) == k, newest)).alias(f"_{n}") for n, k in zip(names, kinds, strict=True)])
    every = F.lit(True)
    columns = []
    for name in names:
        every = every & F.coalesce(F.col(f"_{name}.status") == ok, F.lit(False))
        columns += [F.col(f"_{name}.status").alias(f"{name}_status"),
                    F.coalesce(F.col(f"_{name}.rows"), F.lit(0).cast("bigint")).alias(f"{name}_rows")]
    return picked.select(day, *columns, every.alias("success"))


def market_report(deals: DataFrame, industry: str, amount: str, project: str | None = None,
                  order: Sequence[str] = ()) -> DataFrame:
    """Sum of winning amounts per primary industry.

    Several notices of one project would count twice; name ``project`` to keep
    only the last record of each in ``order`` first. A record without a project is a deal of its own.
    """
    if project:
        named = dedup_last(deals.where(~is_blank(project)), [project], order)
        deals = named.unionByName(deals.where(is_blank(project)))
    return deals.groupBy(industry).agg(F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("deals"))


def notification_failures(notifications: DataFrame, status: str = "status") -> DataFrame:
    """Notifications that have not been sent."""
    return notifications.agg(F.count_if(F.col(status) != "sent").alias("notification_failures"))
