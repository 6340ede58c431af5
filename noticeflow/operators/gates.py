"""Batch-level checks. Each gives rows; ``assert_gate`` turns violations into an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import valid_key
from ..functions.labels import region_rank
from ..schema import CRITERIA_TYPE, REGIONS
from .filters import criteria_equal


class GateError(RuntimeError):
    """A check failed; nothing may be loaded."""


def assert_gate(violations: DataFrame, message: str) -> None:
    """Raise with a few examples when there is any row."""
    examples = violations.take(5)
    if examples:
        raise GateError(f"{message}: {examples}")


def schema_diff(required: DataFrame, described: DataFrame) -> DataFrame:
    """One row per required field: missing, not createable, not updateable, ok.

    Both sides are lists of fields of one object, a few dozen rows.
    """
    fields = described.select("name", F.col("createable").alias("_c"), F.col("updateable").alias("_u"),
                              F.lit(True).alias("_known"))
    problem = (F.when(F.col("_known").isNull(), "missing")
               .when(~F.coalesce("_c", F.lit(False)), "not_createable")
               .when(~F.coalesce("_u", F.lit(False)), "not_updateable").otherwise("ok"))
    return required.select("name").distinct().join(fields, "name", "left").select("name", problem.alias("problem"))


def schema_gate(required: DataFrame, described: DataFrame, key: str) -> DataFrame:
    """One row: counts of schema problems, key flags, and whether a load may start."""
    diff = schema_diff(required, described)
    key_row = described.where(F.col("name") == key)
    external = key_row.agg(F.coalesce(F.bool_or("externalId"), F.lit(False)).alias("x")).scalar()
    unique = key_row.agg(F.coalesce(F.bool_or("unique"), F.lit(False)).alias("x")).scalar()
    counts = diff.agg(*[F.count_if(F.col("problem") == p).alias(p)
                        for p in ("missing", "not_createable", "not_updateable")])
    counts = counts.select("*", external.alias("key_external_id"), unique.alias("key_unique"))
    return counts.withColumn("schema_ok", (F.col("missing") == 0) & (F.col("not_createable") == 0)
                             & (F.col("not_updateable") == 0) & F.col("key_external_id") & F.col("key_unique"))


def preflight(rows: DataFrame, schema: DataFrame, comparison: DataFrame, overlap: DataFrame) -> DataFrame:
    """One row: unchanged, ready or blocked.

    ``rows``, ``schema``, ``comparison`` and ``overlap`` are the one-row results
    of a row count, ``schema_gate``, ``compare_keys`` and ``legacy_overlap``.
    """
    pending = rows.select("pending_rows").scalar()
    schema_ok = schema.select("schema_ok").scalar()
    keys_ok = comparison.select("safe_to_upsert").scalar()
    safe = schema_ok & keys_ok & (F.col("overlap_rows") == 0)
    status = F.when(pending == 0, "unchanged").when(safe, "ready").otherwise("blocked")
    return overlap.select(status.alias("status"), pending.alias("pending_rows"), schema_ok.alias("schema_ok"),
                          keys_ok.alias("keys_ok"), F.col("overlap_rows").alias("legacy_overlap_rows"),
                          ((pending == 0) | safe).alias("safe_to_execute"))


def warnings_gate(rows: DataFrame, warnings: dict[str, Column]) -> DataFrame:
    """(warning, rows) for every warning that occurs; any of them stops a load."""
    names = list(warnings)
    counts = rows.agg(*[F.count_if(F.coalesce(warnings[n], F.lit(False))).alias(f"n{i}") for i, n in enumerate(names)])
    listed = F.array(*[F.struct(F.lit(n).alias("warning"), F.col(f"n{i}").alias("rows")) for i, n in enumerate(names)])
    return counts.select(F.inline(listed)).where("rows > 0")


# Fixed values of the load contract.
LOAD_OBJECT, LOAD_OPERATION, LOAD_KEY, LOAD_DONE = "bidnews__c", "upsert", "Source_Key__c", "JobComplete"
LOAD_RUNNING = ["Open", "UploadComplete", "InProgress"]


def load_audit(jobs: DataFrame, expected: str, object_name: str = LOAD_OBJECT, key: str = LOAD_KEY) -> DataFrame:
    """Add ``accepted`` and the first ``problem`` of each load record."""
    def differs(name: str, value: Column) -> Column:
        return ~F.coalesce(F.col(name) == value, F.lit(False))

    problem = (
        F.when(differs("object", F.lit(object_name)), "object")
        .when(differs("operation", F.lit(LOAD_OPERATION)), "operation")
        .when(differs("externalIdFieldName", F.lit(key)), "key field")
        .when(differs("state", F.lit(LOAD_DONE)), "state")
        .when(differs("numberRecordsProcessed", F.col(expected)), "processed")
        .when(differs("numberRecordsFailed", F.lit(0)), "failed"))
    return jobs.withColumn("problem", problem).withColumn("accepted", F.col("problem").isNull())


def latest_matching_job(jobs: DataFrame, started_at: Column, expected_rows: int | Column,
                        object_name: str = LOAD_OBJECT, key: str = LOAD_KEY) -> DataFrame:
    """Newest settled load of this object and key since ``started_at``.

    A completed load must have the expected number of rows; one that ended
    otherwise is returned too, so that the audit can reject it.
    """
    settled = jobs.where(
        (F.col("createdDate") >= started_at) & (F.col("object") == object_name)
        & (F.col("operation") == LOAD_OPERATION) & (F.col("externalIdFieldName") == key)
        & ~F.col("state").isin(*LOAD_RUNNING)
        & ((F.col("numberRecordsProcessed") == expected_rows) | (F.col("state") != LOAD_DONE)))
    return settled.orderBy(F.col("createdDate").desc(), F.col("id").desc()).limit(1)


def verify_modified_since(keys: DataFrame, target: DataFrame, key: str, modified: str, since: Column,
                          expected_rows: int | Column, key_is_digest: bool = True) -> DataFrame:
    """One row: are all keys distinct, valid and changed in the target since the start."""
    per_key = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    changed = target.where(F.col(modified) >= since).select(key).distinct().withColumn("_changed", F.lit(True))
    valid = valid_key(key) if key_is_digest else F.col(key).isNotNull()
    counts = per_key.join(changed, key, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(~valid).alias("invalid_keys"), F.count("_changed").alias("modified_keys"))
    expected = F.lit(expected_rows) if isinstance(expected_rows, int) else expected_rows
    return counts.withColumn("verified", (F.col("rows") == expected) & (F.col("distinct_keys") == expected)
                             & (F.col("invalid_keys") == 0) & (F.col("modified_keys") == expected))


def quota_invariant(orders: DataFrame, taken: str, balance: str, remaining: str, fee: str | None = None,
                    limit: int = 800) -> DataFrame:
    """Orders that break 0 < taken <= min(limit, balance), the remainder, or the zero fee."""
    ok = ((F.col(taken) > 0) & (F.col(taken) <= F.least(F.lit(limit), F.col(balance)))
          & (F.col(remaining) == F.col(balance) - F.col(taken)))
    if fee:
        ok = ok & (F.coalesce(F.col(fee), F.lit(0)) == 0)
    return orders.where(~F.coalesce(ok, F.lit(False)))


def checkpoint_valid(checkpoint: DataFrame, criteria: Column | None = None, date: str = "date",
                     count: str = "national_count") -> DataFrame:
    """(date, problem) of checkpoint rows that are unreadable, have other criteria or a bad count, or repeat a day."""
    problem = F.when(F.col(count).isNull() | (F.col(count) < 0), "count")
    if criteria is not None:
        same = (F.col("criteria.region") == criteria["region"])
        for name in CRITERIA_TYPE.names[1:]:
            same = same & criteria_equal(F.col(f"criteria.{name}"), criteria[name])
        problem = F.coalesce(problem, F.when(~F.coalesce(same, F.lit(False)), "criteria"))
    unreadable = F.col("unreadable").isNotNull() if "unreadable" in checkpoint.columns else F.col(date).isNull()
    problem = F.when(unreadable, "unreadable").otherwise(problem)
    bad = checkpoint.select(F.col(date).alias("date"), problem.alias("problem")).where("problem is not null")
    repeated = (checkpoint.where(~unreadable).groupBy(F.col(date).alias("date")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select("date", F.lit("repeated").alias("problem")))
    return bad.unionByName(repeated)


def chunk_total(chunks: DataFrame, rows: str, expected: Column | int) -> DataFrame:
    """One row: rows over all chunks against the rows written."""
    total = F.coalesce(F.sum(rows), F.lit(0)).cast("bigint")
    return chunks.agg(total.alias("chunk_rows")).select(
        "chunk_rows", (F.col("chunk_rows") == expected).alias("complete"))


def unknown_regions(rows: DataFrame, region: str, regions: Sequence[str] = REGIONS) -> DataFrame:
    """(region, rows) of names that are not the name of exactly one region; any of them stops a plan."""
    named = rows.groupBy(F.col(region).alias("region")).agg(F.count(F.lit(1)).alias("rows"))
    return named.where(region_rank("region", regions, strict=False).isNull())


def region_list_valid(regions: DataFrame, region: str) -> DataFrame:
    """One row: the list is not empty and has no repeated region."""
    counts = regions.agg(F.count(region).alias("listed"), F.count_distinct(region).alias("distinct_regions"))
    return counts.withColumn("valid", (F.col("listed") > 0) & (F.col("listed") == F.col("distinct_regions")))

