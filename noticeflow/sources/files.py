"""File discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, root: str, glob: str = "*.xlsx") -> DataFrame:
    """Files below ``root`` as (path, modificationTime, length, content).

    Office lock files (``~$name``) are left out. Content is only read by plans
    that use it.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root))
    base = F.element_at(F.split("path", "/"), -1)
    return files.where(~F.startswith(base, F.lit("~$")))


def require_files(files: DataFrame, root: str = "") -> DataFrame:
    """Raise when nothing was found."""
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no input files below {root}")
    return files


def with_digest(files: DataFrame, content: str = "content") -> DataFrame:
    """Add ``sha256`` of the file content."""
    return files.withColumn("sha256", F.sha2(F.col(content), 256))
