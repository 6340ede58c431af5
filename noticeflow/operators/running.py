"""Running totals that do not end up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpointed


def running_total(rows: DataFrame, value: str, order: Sequence[str], group: Sequence[str] = (),
                  name: str = "running", partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order``, per ``group`` if given.

    A plain window needs a whole group in one task. Here the rows are range
    partitioned on (group, order); each range sums on its own and is shifted by
    the total of the ranges before it. The range layout is checkpointed into the
    shared folder, so a lost executor cannot move a row to another range. Pass
    narrow rows: order must be unique within a group, group and order not NULL.
    """
    keys = [*group, *order]
    count = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (rows.repartitionByRange(count, *keys)
              .withColumn("_range", F.spark_partition_id()))
    ranged = checkpointed(ranged)
    by_range = [*group, "_range"]
    # One row per group and range: at most `count` rows for each group.
    totals = ranged.groupBy(*by_range).agg(F.sum(value).alias("_total"))
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*by_range, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*by_range).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.withColumn("_local", F.sum(value).over(inside))
    return (local.join(offsets, by_range)
            .withColumn(name, F.col("_local") + F.col("_offset")).select(*rows.columns, name))
