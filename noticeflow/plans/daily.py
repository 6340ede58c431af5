"""Daily counts: count the days that are missing, append them, rebuild the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import daily_counts, day_spine, missing_dates
from ..operators.gates import assert_gate, checkpoint_valid
from ..schema import CHECKPOINT_SCHEMA
from ..session import checkpointed
from ..sinks.files import append_checkpoint, write_daily_counts
from ..sources.tables import read_checkpoint


def collect_days(spark: SparkSession, notices: DataFrame, day: str, first: str, last: str,
                 checkpoint: str, output: str, criteria: Column, started: bool = True) -> int:
    """Count the days of the range that the checkpoint lacks; returns how many were added.

    ``started`` says whether a checkpoint exists already.
    """
    done = read_checkpoint(spark, checkpoint) if started else spark.createDataFrame([], CHECKPOINT_SCHEMA)
    assert_gate(checkpoint_valid(done, criteria), "checkpoint has invalid rows")
    todo = checkpointed(missing_dates(day_spine(spark, first, last), done))
    # Only rows of missing days are counted; the day list is short by nature.
    rows = notices.join(todo.withColumnRenamed("date", day), day, "left_semi")
    counted = daily_counts(rows, day, todo).select(
        "date", "national_count", F.current_timestamp().alias("queried_at"), criteria.alias("criteria"))
    added = todo.count()
    if added:
        append_checkpoint(counted, checkpoint)
    write_daily_counts(read_checkpoint(spark, checkpoint) if added or started else done, output)
    return added
