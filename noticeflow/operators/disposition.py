"""What happened to each input row: skipped, missing key, duplicate, blocked or written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKIPPED, MISSING, DUPLICATE, BLOCKED, WRITTEN = (
    "skipped_category", "missing_key", "duplicate", "blocked", "written")


def with_disposition(df: DataFrame, key: str, order: Sequence[str], allowed: Column, complete: Column,
                     length: Column, limit: int) -> DataFrame:
    """Label every row, in the order category, required fields, duplicate, size.

    The first row of each key is found by a combining aggregate and joined back
    on the row position, which is unique, so a key that covers a third of the
    table is spread like any other rows. ``order`` must be unique.
    """
    # Plain conditions here, so that a category list reaches the scan.
    eligible = df.where(allowed).where(complete)
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    firsts = eligible.groupBy(key).agg(F.min(position).alias("_position"))
    marks = (firsts.select(F.col("_position").alias(order[0])) if len(order) == 1
             else firsts.select(*[F.col(f"_position.{c}").alias(c) for c in order]))
    # Flags are made before the join: a report that does not use the body must
    # not carry it through the join's shuffle just to measure it afterwards.
    flagged = df.withColumns({"_allowed": F.coalesce(allowed, F.lit(False)), "_over": length > limit,
                              "_complete": F.coalesce(complete, F.lit(False))})
    labelled = flagged.join(marks.withColumn("_first", F.lit(True)), list(order), "left")
    disposition = (
        F.when(~F.col("_allowed"), SKIPPED).when(~F.col("_complete"), MISSING)
        .when(F.col("_first").isNull(), DUPLICATE).when(F.col("_over"), BLOCKED).otherwise(WRITTEN))
    return labelled.withColumn("disposition", disposition).drop("_first", "_allowed", "_complete", "_over")


def disposition_counts(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return labelled.groupBy(*by, "disposition").agg(F.count(F.lit(1)).alias("rows"))


def batch_report(df: DataFrame, key: str, order: Sequence[str], allowed: Column, complete: Column, length: Column,
                 limit: int, file: str, warnings: dict[str, Column] | None = None) -> DataFrame:
    """One row: files, rows read, written, duplicate, blocked, skipped, and warning counts.

    Counts need no label per row: one scan and one combining aggregate per key tell
    how many rows a key has and whether its first one is too long.
    """
    flags = warnings or {}
    narrow = df.select(
        F.col(key).alias("_key"), F.struct(*order).alias("_position"), F.col(file).alias("_file"),
        F.coalesce(allowed, F.lit(False)).alias("_allowed"), F.coalesce(complete, F.lit(False)).alias("_complete"),
        F.coalesce(length > limit, F.lit(False)).alias("_over"),
        *[F.coalesce(flag, F.lit(False)).alias(f"_flag{i}") for i, flag in enumerate(flags.values())])
    eligible = F.col("_allowed") & F.col("_complete")
    per_key = narrow.groupBy(eligible.alias("_eligible"), F.when(eligible, F.col("_key")).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min_by("_over", "_position").alias("_over"),
        F.count_if(~F.col("_allowed")).alias("_skipped"),
        *[F.count_if(F.col(f"_flag{i}")).alias(f"_flag{i}") for i in range(len(flags))])
    first = F.col("_eligible")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))

    files = narrow.agg(F.count_distinct("_file").alias("n")).scalar()
    return per_key.agg(
        total(F.col("_rows")).alias("rows_read"), F.count_if(first & ~F.col("_over")).alias("rows_written"),
        total(F.when(first, F.col("_rows") - 1)).alias("duplicates_skipped"),
        F.count_if(first & F.col("_over")).alias("blocked_rows"), total(F.col("_skipped")).alias("categories_skipped"),
        total(F.when(~first, F.col("_rows") - F.col("_skipped"))).alias("missing_key_data"),
        *[total(F.col(f"_flag{i}")).alias(name) for i, name in enumerate(flags)]).select(files.alias("source_files"), "*")


def counts_by_date(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
