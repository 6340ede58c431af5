"""First-wins, last-wins, newest-per-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _ranked(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # rank = 1 lets Spark keep one row per key in each map task before the
    # shuffle, so copies of a hot key never meet in one reducer.
    window = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key; ``order`` must be unique within a key."""
    return _ranked(df, key, [F.col(c).asc() for c in order])


def dedup_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row of each key."""
    return _ranked(df, key, [F.col(c).desc() for c in order])


def latest_per_group(df: DataFrame, group: Sequence[str], modified: str,
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest row per group by modification time."""
    return dedup_last(df, group, [modified, *tiebreak])
