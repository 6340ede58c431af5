"""Insert-or-update by a unique key."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.dedup import dedup_last
from .files import remove_folder
from .log import commit, forget, read_version


def _merged(source: str, target: str, column: str, overwrite_with_null: bool) -> Column:
    new, old = F.col(f"{source}.{column}"), F.col(f"{target}.{column}")
    if overwrite_with_null:
        return F.when(F.col(f"{source}._given"), new).otherwise(old).alias(column)
    return F.coalesce(new, old).alias(column)


def upsert(target: DataFrame, source: DataFrame, key: str, overwrite_with_null: bool = False,
           incremental: bool = False) -> DataFrame:
    """Target after applying ``source``; keys must be unique on both sides.

    Blank source values keep the stored value unless ``overwrite_with_null``.
    The default is one full outer join. ``incremental`` suits a batch that is
    small next to the target: the target is only left-joined, which Spark turns
    into a map-side join when the batch is small enough, and new keys are added
    by an anti join on keys alone. The source may not have columns that the target lacks.
    """
    columns = target.columns
    if unknown := [c for c in source.columns if c not in columns]:
        raise ValueError(f"columns that the target lacks: {unknown}")
    extra = [c for c in columns if c not in source.columns]
    given = source.select(*source.columns, *[F.lit(None).alias(c) for c in extra],
                          F.lit(True).alias("_given"))
    values = [c for c in columns if c != key]

    def joined(how: str) -> DataFrame:
        pairs = target.alias("t").join(given.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), how)
        merged = [_merged("s", "t", c, overwrite_with_null and c not in extra) for c in values]
        return pairs.select(F.coalesce(f"s.{key}", f"t.{key}").alias(key), *merged)

    if not incremental:
        return joined("full_outer").select(*columns)
    known = target.select(key).join(source.select(key), key, "left_semi")
    inserted = given.join(known, key, "left_anti").select(*columns)
    return joined("left").select(*columns).unionByName(inserted)


# Bodies are most of the bytes: a level above the default one takes them down by another fifteenth.
COMPRESSED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}

# --- a stored table: a log of versions, each a snapshot and the loads after it ---
#
# A load is a folder with the rows of its batch as they came. Nothing stored is read or rewritten
# by a load; readers merge the loads of a version by key, and compaction folds them
# into a snapshot when there are many. A folder counts once a commit lists it, so a load that dies
# half way changes nothing, and of two writers neither is lost.


@dataclass
class Load:
    """Rows that are written but not yet committed."""

    entry: dict
    rows: int
    folder: str
    cluster: str = ""
    cluster_of_key: bool = False
    side: dict[str, tuple[str, str]] = field(default_factory=dict)


def _frames(spark: SparkSession, root: str, entries: Sequence[dict]) -> list[DataFrame]:
    return [spark.read.parquet(f"{root.rstrip('/')}/{e['folder']}") for e in entries]


def _merged_loads(spark: SparkSession, root: str, entries: Sequence[dict], key: str) -> DataFrame:
    """One row per key: each column has its newest value; a blank only counts where the load may blank values."""
    frames = _frames(spark, root, entries)
    names = list(dict.fromkeys(c for f in frames for c in f.columns))
    order = next((e["order"] for e in reversed(entries) if e["order"]), [])
    marked = [f.withColumns({"_load": F.lit(n), "_blanks": F.lit(e["blanks"]),
                             "_lacks": F.array(*[F.lit(c) for c in names if c not in f.columns]).cast("array<string>")})
              for n, (f, e) in enumerate(zip(frames, entries, strict=True))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    if all(e["blanks"] for e in entries) and all(len(f.columns) == len(names) for f in frames):
        return dedup_last(rows, [key], [*order, "_load"]).select(*names)
    if order:  # a row older than one before it does not count
        before = W.partitionBy(key).orderBy("_load").rowsBetween(W.unboundedPreceding, -1)
        newest = F.max(F.struct(*order)).over(before)
        rows = rows.withColumn("_newest", newest).where(F.col("_newest").isNull() | (F.struct(*order) >= F.col("_newest")))

    def newest_value(c: str) -> Column:
        counts = F.col(c).isNotNull() | (F.col("_blanks") & ~F.array_contains("_lacks", c))
        return F.max_by(c, F.when(counts, F.col("_load"))).alias(c)

    return rows.groupBy(key).agg(*[newest_value(c) for c in names if c != key]).select(*names)


def read_table(spark: SparkSession, root: str, key: str) -> DataFrame | None:
    """Current rows of a stored table, one per key; None before its first load."""
    entries = read_version(spark, root)[1]["folders"]
    if not entries:
        return None
    if len(entries) == 1:
        return _frames(spark, root, entries)[0]
    return _merged_loads(spark, root, entries, key)


def compact_table(spark: SparkSession, root: str, key: str, cluster: str) -> bool:
    """Write the current rows as a snapshot in place of the loads it was made from; loads committed meanwhile stay.

    False if another compaction was faster; then nothing changes. The folders left behind go with ``clean_table``.
    """
    entries = read_version(spark, root)[1]["folders"]
    if len(entries) < 2:
        return False
    name = f"snapshot-{uuid.uuid4().hex}"
    load = _write(_merged_loads(spark, root, entries, key), root, name, key, cluster, (), True)

    def replace(version: dict) -> dict | None:
        if version["folders"][: len(entries)] != entries:
            return None
        order = next((e["order"] for e in reversed(entries) if e["order"]), [])
        return {**version, "folders": [{**load.entry, "order": order}, *version["folders"][len(entries) :]]}

    if commit(spark, root, replace) is None:
        remove_folder(spark, load.folder)
        return False
    return True


def clean_table(spark: SparkSession, root: str, older_than: float = 7 * 86_400) -> list[str]:
    """Delete folders that no version lists and old commits; returns the folders.

    ``older_than`` seconds must be longer than any load or reader takes, as their folders are not listed yet, or no more.
    """
    listed = {e["folder"] for e in read_version(spark, root)[1]["folders"]}
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*-*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    dead = [s.getPath() for s in files.globStatus(pattern) or []
            if s.getPath().getName() not in listed and s.getModificationTime() / 1000 <= time.time() - older_than]
    for path in dead:
        files.delete(path, True)
    forget(spark, root)
    return [path.getName() for path in dead]


def _write(rows: DataFrame, root: str, name: str, key: str, cluster: str, order: Sequence[str], blanks: bool,
           laid_out: bool = False) -> Load:
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
    folder = f"{root.rstrip('/')}/{name}"
    placed = counted if laid_out else counted.hint("rebalance", cluster)
    placed.write.mode("errorifexists").options(**COMPRESSED).parquet(folder)
    found = seen.get
    ranged = all(isinstance(found[k], (int, str)) for k in ("low", "high"))
    entry = {"folder": name, "blanks": blanks, "order": list(order), "rows": found["rows"],
             "low": found["low"] if ranged else None, "high": found["high"] if ranged else None}
    return Load(entry, found["rows"], folder)


def stage_load(spark: SparkSession, root: str, source: DataFrame, key: str, cluster: str, order: Sequence[str] = (),
               overwrite_with_null: bool = False, cluster_of_key: bool = False, laid_out: bool = False) -> Load:
    """Write the rows of a batch (unique keys), laid out by ``cluster``; ``commit_load`` makes them count.

    Rows that come ``laid_out`` by it are written as they lie, without a shuffle.
    """
    load = _write(source, root, f"load-{uuid.uuid4().hex}", key, cluster, order, overwrite_with_null, laid_out)
    load.cluster, load.cluster_of_key = cluster, cluster_of_key
    return load


def _may_hold(entry: dict, load: dict) -> bool:
    """Whether a folder's range of keys meets that of the load."""
    bounds = [entry["low"], entry["high"], load["low"], load["high"]]
    if not entry["rows"] or not load["rows"]:
        return False
    if any(b is None for b in bounds) or len({type(b) for b in bounds}) > 1:
        return True
    return entry["low"] <= load["high"] and load["low"] <= entry["high"]


def known_keys(spark: SparkSession, root: str, entries: Sequence[dict], load: Load, key: str) -> DataFrame | None:
    """The load's keys that the given folders hold. Only key columns are read, and only of folders whose keys may meet the load's.

    Where the ``cluster`` value is part of the key, rows outside the load's range of it are skipped as well.
    """
    entries = [e for e in entries if _may_hold(e, load.entry)]
    if not entries:
        return None
    own = spark.read.parquet(load.folder)
    columns = list(dict.fromkeys([key, load.cluster])) if load.cluster_of_key else [key]
    stored = reduce(DataFrame.unionByName, [f.select(*columns) for f in _frames(spark, root, entries)])
    if load.cluster_of_key:
        low, high, blanks = own.agg(F.min(load.cluster), F.max(load.cluster), F.count_if(F.col(load.cluster).isNull())).first()
        inside = F.col(load.cluster).between(F.lit(low), F.lit(high))
        stored = stored.where(inside | F.col(load.cluster).isNull() if blanks else inside)
    return own.select(key).join(stored.select(key), key, "left_semi")


def commit_load(spark: SparkSession, root: str, load: Load | None, key: str, count_inserted: bool = True,
                side: dict[str, tuple[str, str]] | None = None, applied: tuple[str, int] | None = None) -> dict:
    """Make a written load count, with what belongs to it, in one commit; returns folder, rows, inserted rows and the number of loads.

    ``side`` maps a name to (add or set, folder): other folders of the same version, as a manifest. ``applied`` is
    (stream, batch number): a batch that the table has already is not added again.
    """
    result: dict = {"folder": load.folder if load else None, "rows": load.rows if load else 0, "inserted": None}

    def add(version: dict) -> dict | None:
        if applied and version["applied"].get(applied[0], -1) >= applied[1]:
            result.update(rows=0, inserted=0)
            return None
        if load and count_inserted:
            known = known_keys(spark, root, version["folders"], load, key)
            result["inserted"] = load.rows - (known.count() if known is not None else 0)
        kept = dict(version["side"])
        for name, (how, folder) in (side or {}).items():
            kept[name] = [*(kept.get(name, []) if how == "add" else []), folder]
        done = {**version["applied"], **({applied[0]: applied[1]} if applied else {})}
        return {**version, "folders": [*version["folders"], *([load.entry] if load else [])], "side": kept, "applied": done}

    version = commit(spark, root, add)
    if version is None and load:
        remove_folder(spark, load.folder)
    return {**result, "loads": len(version["folders"]) if version else None}


def side_folders(spark: SparkSession, root: str, name: str) -> list[str]:
    return read_version(spark, root)[1]["side"].get(name, [])


def upsert_table(spark: SparkSession, root: str, source: DataFrame, key: str, cluster: str,
                 order: Sequence[str] = (), overwrite_with_null: bool = False,
                 cluster_of_key: bool = False, count_inserted: bool = True, applied: tuple[str, int] | None = None,
                 verify: Callable[[str], None] | None = None, compact_after: int | None = None) -> dict:
    """Apply ``source`` (unique keys) as one load; returns its folder and the rows written and inserted.

    No stored row is read, but with ``count_inserted`` the stored keys that may be the batch's (``known_keys``). Blank values
    keep the stored ones unless ``overwrite_with_null``; new columns are added to the table. With ``order`` a row older
    than the stored one does not count, so batches may come in any order. ``verify`` gets the folder before the load
    counts and may raise. Beyond ``compact_after`` loads the table is compacted.
    """
    load = stage_load(spark, root, source, key, cluster, order, overwrite_with_null, cluster_of_key)
    if verify:
        verify(load.folder)
    result = commit_load(spark, root, load, key, count_inserted, applied=applied)
    if compact_after and (result["loads"] or 0) > compact_after:
        compact_table(spark, root, key, cluster)
    return result
