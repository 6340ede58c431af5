"""Numbered commits of a stored table.

A commit is a small JSON file below ``_commits`` that lists the folders of one
version. It is written aside and renamed to the next number, which fails if another
writer was first; then the change is made again on the new version. Needs a file system whose rename
does not replace files, as HDFS.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

EMPTY = {"folders": [], "side": {}, "applied": {}}


def _files(spark: SparkSession, root: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_commits")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, files = _files(spark, root)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.json")
    return sorted(int(s.getPath().getName().removesuffix(".json")) for s in files.globStatus(pattern) or [])


def _path(spark: SparkSession, root: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_commits/{name}")


def read_version(spark: SparkSession, root: str) -> tuple[int, dict]:
    """(number, version) of the newest commit; (0, empty) before the first one."""
    numbers = _numbers(spark, root)
    if not numbers:
        return 0, json.loads(json.dumps(EMPTY))
    _, files = _files(spark, root)
    stream = files.open(_path(spark, root, f"{numbers[-1]:020d}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return numbers[-1], json.loads(text)


def _try_commit(spark: SparkSession, root: str, number: int, version: dict) -> bool:
    _, files = _files(spark, root)
    aside = _path(spark, root, f".{uuid.uuid4().hex}.tmp")
    out = files.create(aside, False)
    out.write(bytearray(json.dumps(version).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(aside, _path(spark, root, f"{number:020d}.json"),
                       spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def commit(spark: SparkSession, root: str, change: Callable[[dict], dict | None]) -> dict | None:
    """Apply ``change`` to the newest version and store the result as the next one.

    Called again with the newer version when another writer was first; None ends without a commit.
    """
    while True:
        number, version = read_version(spark, root)
        changed = change(version)
        if changed is None or _try_commit(spark, root, number + 1, changed):
            return changed


def forget(spark: SparkSession, root: str, keep: int = 10) -> None:
    """Delete all but the newest ``keep`` commits; readers of an older version must have ended."""
    _, files = _files(spark, root)
    for number in _numbers(spark, root)[:-keep]:
        files.delete(_path(spark, root, f"{number:020d}.json"), False)
