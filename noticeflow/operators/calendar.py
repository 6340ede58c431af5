"""Days still to count, and zero-filled daily counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day of the inclusive range."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def spine_of(df: DataFrame, day: str) -> DataFrame:
    """Every day from the first to the last one in the data."""
    bounds = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return bounds.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("date"))


def missing_dates(spine: DataFrame, done: DataFrame, done_day: str = "date") -> DataFrame:
    """Days of the spine without a completed record."""
    completed = done.select(F.col(done_day).alias("date")).distinct()
    return spine.join(completed, "date", "left_anti")


def daily_counts(rows: DataFrame, day: str, spine: DataFrame) -> DataFrame:
    """Rows per day of the spine, zero where there are none."""
    counts = rows.groupBy(F.col(day).alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "date", "left").select(
        "date", F.coalesce("n", F.lit(0).cast("bigint")).alias("national_count"))
