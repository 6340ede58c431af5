"""Writers for load files, reports, checkpoints and snapshots."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MANIFEST_SCHEMA
from ..sources.tables import CSV_OPTIONS


def write_load_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Header plus fixed column order, missing values as empty text.

    Records end in a newline: asking Spark for CRLF would also rewrite newlines
    inside quoted bodies.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    df.select(*text).write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """One JSON document; ``df`` is a one-row metrics frame."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_daily_counts(checkpoint: DataFrame, root: str, date: str = "date",
                       count: str = "national_count") -> str:
    """Write the whole date/count table in date order as a new snapshot folder, read with ``current_snapshot``.

    A run that dies leaves the table before it in place.
    """
    folder = f"{root.rstrip('/')}/snapshot-{time.time_ns():020d}"
    (checkpoint.select(date, count).repartitionByRange(date).sortWithinPartitions(date)
     .write.mode("errorifexists").option("header", True).csv(folder))
    return folder


def append_checkpoint(days: DataFrame, path: str) -> None:
    """Append completed days as JSON lines."""
    days.write.mode("append").json(path)


def complete_folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Folders ``prefix-*`` below the root that have their success marker, in order of name."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{prefix}-*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().getParent().toString() for status in found or [])


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    """Newest complete snapshot folder, or None before the first one."""
    return next(reversed(complete_folders(spark, root, "snapshot")), None)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job has made."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def commit_manifest(files: DataFrame, path: str, job_id: str | None, ledger: str = "files") -> None:
    """Append (path, sha256) of loaded files. Call only after the load was verified."""
    (files.select("path", "sha256", F.lit(ledger).alias("ledger"),
                  F.lit(job_id).cast("string").alias("job_id"),
                  F.current_timestamp().alias("committed_at"))
     .select(*MANIFEST_SCHEMA.names).write.mode("append").parquet(path))
