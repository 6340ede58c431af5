"""One incremental load: new or changed workbooks into a stored target table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import truncate
from ..operators.compare import compare_keys
from ..operators.dedup import dedup_first
from ..operators.gates import (GateError, assert_gate, preflight, schema_gate, verify_modified_since,
                               warnings_gate)
from ..operators.incremental import merge_quarantine, pending_files
from ..operators.legacy import legacy_overlap
from ..schema import ALLOWED_CATEGORIES, FIELD_RULES, MANIFEST_SCHEMA
from ..session import checkpointed, shared_dir, shuffles_dropped
from ..sinks.files import commit_manifest, remove_folder
from ..sinks.upsert import COMPRESSED, commit_load, read_table, side_folders, stage_load
from ..sources.files import with_digest
from ..sources.landing import stream_changed_files
from ..sources.workbooks import parse_workbooks, resolve_formulas
from .prepare import WARNING_FLAGS, complete, eligible, is_eligible, notice_report, split_by_size, to_notices

KEY, DAY, MODIFIED = "Source_Key__c", "release_date__c", "LastModifiedDate"
BODY, SHORT_BODY, ROW_ID = "Source_Content__c", "content__c", "_id"
# Numbers of rows that are broadcast, about 40 MB; beyond that the rows are shuffled to them.
BROADCAST_IDS = 1_000_000


@dataclass
class SyncPaths:
    """Shared folders of one target."""

    target: str
    manifest: str
    queue: str


def load_manifest(spark: SparkSession, paths: SyncPaths) -> DataFrame:
    """The files that the current version of the target was loaded from."""
    folders = side_folders(spark, paths.target, "manifest")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], MANIFEST_SCHEMA)


def record_files(spark: SparkSession, paths: SyncPaths, files: DataFrame, ledger: str) -> None:
    """Enter files (path, sha256) into a ledger of the manifest without loading them."""
    folder = f"{paths.manifest.rstrip('/')}/files-{uuid4().hex}"
    commit_manifest(files, folder, None, ledger)
    commit_load(spark, paths.target, None, KEY, side={"manifest": ("add", folder)})


def _stage(notices: DataFrame, folder: str) -> DataFrame:
    """Parse and type the batch once, into the shared folder, laid out by day; all later steps read columns of it.

    Rows are numbered. Bodies are those of eligible rows, others are not loaded; a body is staged once: the short one
    is cut from it again by those who read it.
    """
    body = F.when(is_eligible(), F.col(BODY)).alias(BODY)
    rows = notices.select(*[body if c == BODY else c for c in notices.columns if c != SHORT_BODY])
    rows = rows.hint("rebalance", DAY).withColumn(ROW_ID, F.monotonically_increasing_id())
    rows.write.options(**COMPRESSED).parquet(folder)
    staged = notices.sparkSession.read.schema(rows.schema).parquet(folder)
    _, _, length = FIELD_RULES[SHORT_BODY]
    return staged.withColumn(SHORT_BODY, truncate(BODY, length)).select(*notices.columns, ROW_ID)


def _firsts(staged: DataFrame, keys: int, copies: int) -> DataFrame:
    """The eligible row of each key that comes first. Keys and places are shuffled, bodies stay where they lie.

    What is fewer is marked: the first rows, or the ``copies`` that follow them.
    """
    rows = eligible(staged)
    marked = dedup_first(rows.select(KEY, "_path", "_row", ROW_ID), [KEY], ["_path", "_row", ROW_ID]).select(ROW_ID)
    if copies < keys:
        marked = rows.select(ROW_ID).join(marked, ROW_ID, "left_anti")
    marked = checkpointed(marked)
    return rows.join(F.broadcast(marked) if min(copies, keys) <= BROADCAST_IDS else marked, ROW_ID,
                     "left_anti" if copies < keys else "left_semi")


def _preflight(spark: SparkSession, source: DataFrame, described: DataFrame | None, legacy: DataFrame | None, target: str,
               ignore_keyless: bool) -> dict:
    required = spark.createDataFrame([(name,) for name in source.columns if name != MODIFIED], "name string")
    keys = source.select(KEY).limit(0)
    if described is None:
        # A stored table takes any column, and its keys are unique: what can be wrong is the batch itself.
        own = F.col("name") == KEY
        described = required.select("name", F.lit(True).alias("createable"), F.lit(True).alias("updateable"),
                                    own.alias("externalId"), own.alias("unique"))
    elif (stored := read_table(spark, target, KEY)) is not None:
        keys = stored.select(KEY)
    keyless = source.limit(0) if legacy is None else legacy
    rows = source.agg(F.count(F.lit(1)).alias("pending_rows"))
    listed = keys.unionByName(keyless.select(F.lit(None).cast("string").alias(KEY)))
    return preflight(rows, schema_gate(required, described, KEY), compare_keys(source.select(KEY), listed, KEY, ignore_keyless),
                     legacy_overlap(source, keyless)).first().asDict()


def sync_batch(spark: SparkSession, files: DataFrame, paths: SyncPaths, force: bool = False,
               guarded: bool = False, described: DataFrame | None = None, legacy: DataFrame | None = None,
               ignore_keyless: bool = False) -> dict:
    """Load pending ``files`` (path, content); target, manifest and queue advance in one commit, after verification.

    Running it again after a failure is safe: what did not come to its commit does not count, and what did is in the
    manifest, so a load is not repeated because its confirmation was lost. Read the target with
    ``sinks.read_table(spark, paths.target, KEY)``.

    The preflight always runs: duplicate and missing keys must not occur. ``described`` (the fields of a target) adds its
    fields, key flags and stored keys, and ``legacy`` (its rows without a key, in notice columns) the overlap.
    """
    with shuffles_dropped(spark):
        return _sync(spark, files, paths, force, guarded, described, legacy, ignore_keyless)


def _sync(spark: SparkSession, files: DataFrame, paths: SyncPaths, force: bool, guarded: bool, described: DataFrame | None,
          legacy: DataFrame | None, ignore_keyless: bool) -> dict:
    manifest = load_manifest(spark, paths)
    pending = pending_files(with_digest(files), manifest, force, guarded)
    chosen = checkpointed(pending.select("path", "sha256"))
    queue_folder = next(iter(side_folders(spark, paths.target, "queue")), None)
    found = chosen.count()
    if not found:
        waiting = 0 if queue_folder is None else spark.read.parquet(queue_folder).count()
        return {"status": "blocked_pending" if waiting else "unchanged", "files": 0, "rows": 0,
                "successful_rows": 0, "failed_rows": 0, "blocked_rows": waiting,
                "inserted_rows": 0, "updated_rows": 0, "job_id": None}

    started = datetime.now(timezone.utc)
    # Where all files are pending, none is left out. Else a short list of pending paths
    # is broadcast, and a long one shuffles the bytes of the files once.
    wanted = (files.where(F.col("path").isNotNull()) if found == files.count()
              else files.join(chosen, "path", "left_semi"))
    raw = resolve_formulas(parse_workbooks(wanted))
    stage = shared_dir(spark, "stage")
    staged = _stage(to_notices(raw), stage)
    considered = staged.where(F.col("Publication_Category__c").isin(*ALLOWED_CATEGORIES))
    assert_gate(warnings_gate(considered, {
        **{flag.lstrip("_"): F.col(flag) for flag in WARNING_FLAGS},
        "missing_key_data": ~complete()}), "batch has warnings, nothing was loaded")
    report = notice_report(staged).first().asDict()

    keys = report["rows_written"] + report["blocked_rows"]
    written, blocked = split_by_size(_firsts(staged, keys, report["duplicates_skipped"]))
    queue = blocked.limit(0) if queue_folder is None else spark.read.parquet(queue_folder)
    merged = merge_quarantine(queue, blocked, chosen.withColumnRenamed("path", "Source_File_Path"),
                              "Source_File_Path", "Source_Row_Number__c", [KEY])
    source = written.withColumn(MODIFIED, F.lit(started).cast("timestamp"))
    rows, load, job_id = report["rows_written"], None, None
    if rows:
        check = _preflight(spark, source, described, legacy, paths.target, ignore_keyless)
        if not check["safe_to_execute"]:
            raise GateError(f"preflight blocked the load, nothing was written: {check}")
        # The day is part of the key, so other days of the target are not read.
        load = stage_load(spark, paths.target, source, KEY, DAY, cluster_of_key=True, laid_out=True)
        # All rows of this load are in its folder: the check reads nothing else of the target.
        check = verify_modified_since(source, spark.read.parquet(load.folder), KEY, MODIFIED,
                                      F.lit(started).cast("timestamp"), rows).first()
        if not check["verified"]:
            raise GateError(f"load not verified, manifest unchanged: {check}")
        job_id = uuid4().hex
    queue, listed = (f"{base.rstrip('/')}/files-{uuid4().hex}" for base in (paths.queue, paths.manifest))
    merged.write.parquet(queue)
    waiting = spark.read.parquet(queue).count()
    commit_manifest(chosen, listed, job_id)
    result = commit_load(spark, paths.target, load, KEY, side={"manifest": ("add", listed), "queue": ("set", queue)})
    inserted = result["inserted"] or 0
    remove_folder(spark, stage)
    return {"status": "uploaded_with_blocked" if waiting else "uploaded", "files": found,
            "rows": rows, "successful_rows": rows, "failed_rows": 0, "blocked_rows": waiting,
            "newly_blocked_rows": report["blocked_rows"], "inserted_rows": inserted,
            "updated_rows": rows - inserted, "duplicates_filtered": report["duplicates_skipped"],
            "categories_filtered": report["categories_skipped"], "job_id": job_id}


def stream_sync(spark: SparkSession, folder: str, paths: SyncPaths, checkpoint: str, glob: str = "*.xlsx",
                files_per_load: int = 1000, **options) -> StreamingQuery:
    """``sync_batch`` over what is new or edited below a folder, in loads of a bounded number of files.

    Whether a changed file is loaded is decided by its content: the manifest knows the digest of what has been loaded, so a file that was
    only touched, or a batch that is run again after a crash, loads nothing.
    """
    def apply(batch: DataFrame, number: int) -> None:
        names = sorted({row["path"] for row in batch.select("path").collect()})
        for start in range(0, len(names), files_per_load):
            files = batch.sparkSession.read.format("binaryFile").load(names[start:start + files_per_load])
            sync_batch(batch.sparkSession, files, paths, **options)

    changes = stream_changed_files(spark, folder, f"{checkpoint.rstrip('/')}-files", glob)
    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
