"""Incremental input: file manifest, reviewed ledger, cutover seed, quarantine queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_last


def pending_files(files: DataFrame, manifest: DataFrame, force: bool = False,
                  guarded: bool = False) -> DataFrame:
    """Files whose (path, sha256) is not recorded as loaded.

    A changed file has a new digest and is pending again. The guarded target
    also skips files in the reviewed ledger; ``force`` keeps everything.
    """
    if force:
        return files
    ledgers = ["files", "reviewed"] if guarded else ["files"]
    done = manifest.where(F.col("ledger").isin(*ledgers)).select("path", "sha256")
    return files.join(done, ["path", "sha256"], "left_anti")


def exclude_reviewed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files not recorded, unchanged, in the reviewed ledger."""
    reviewed = manifest.where("ledger = 'reviewed'").select("path", "sha256")
    return files.join(reviewed, ["path", "sha256"], "left_anti")


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """Current digest of each (ledger, path) in an append-only manifest."""
    return dedup_last(manifest, ["ledger", "path"], ["committed_at", "sha256"])


def cutover_seed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row: status initialized, unchanged or conflict, and the number of files.

    Seeding an empty manifest records all current files; the same content again
    changes nothing; any difference is a conflict.
    """
    current = files.select("path", "sha256", F.lit(1).alias("f"), F.lit(0).alias("m"))
    recorded = manifest.where("ledger = 'files'").select("path", "sha256", F.lit(0).alias("f"), F.lit(1).alias("m"))
    pairs = current.unionByName(recorded).groupBy("path", "sha256").agg(F.max("f").alias("f"), F.max("m").alias("m"))
    counts = pairs.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("files"),
                       F.coalesce(F.sum("m"), F.lit(0)).alias("recorded"),
                       F.count_if(F.col("f") != F.col("m")).alias("different"))
    status = (F.when(F.col("recorded") == 0, "initialized")
              .when(F.col("different") == 0, "unchanged").otherwise("conflict"))
    return counts.select(status.alias("status"), "files", "recorded", "different")


def merge_quarantine(queue: DataFrame, run: DataFrame, processed: DataFrame, path: str,
                     row: str, order: Sequence[str]) -> DataFrame:
    """Queue rows of files that were not rescanned, plus this run's rows.

    The last row of a (path, row number) wins; the run comes after the queue.
    ``processed`` lists the rescanned paths.
    """
    kept = queue.join(processed.select(path).distinct(), path, "left_anti")
    both = (kept.withColumn("_run", F.lit(0)).unionByName(run.withColumn("_run", F.lit(1))))
    return dedup_last(both, [path, row], ["_run", *order]).drop("_run")
