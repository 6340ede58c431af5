"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that every job here relies on. Shuffle partition counts are
# left to the cluster; AQE coalesces them after each stage.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even if that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state larger than an executor's heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in ENGINE_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("noticeflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(partitions))
    )
    for name, value in ENGINE_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of an action go when it ends, not when the driver comes to collect its garbage.

    For jobs of several actions that each shuffle anew; a frame that is collected twice would be shuffled twice.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the cluster's checkpoint folder.

    The cluster names the folder in ``spark.checkpoint.dir``. Only a session on
    this one machine (a test) may go without: it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder and read from there."""
    shared_dir(rows.sparkSession, "checkpoint")  # sets a folder where the cluster names none
    return rows.checkpoint()
