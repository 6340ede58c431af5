"""Python data sources over a folder of workbooks: rows by file and row range, and a stream of new and edited files."""

from __future__ import annotations

import fnmatch
import json
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schema import RAW_SCHEMA
from .workbooks import CHUNK, _data_rows, resolve_formulas, row_batches

# Bytes of workbooks for a task; a larger file is cut into ranges of rows.
RANGE_BYTES = 32 << 20
# Ranges of a folder are this many or more before small files are put together beyond the size of a range.
TASKS = 200


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as the session's file systems see it."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(own).toString()


def _opened(uri: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, what stands before such a path in a full one)."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    system, path = fs.FileSystem.from_uri(uri)
    before = uri[:len(uri) - len(path.lstrip("/"))].rstrip("/") if uri.endswith(path.lstrip("/")) else ""
    return system, path, "file:" if isinstance(system, fs.LocalFileSystem) else before


def listed(root: str, glob: str) -> dict[str, tuple[int, int]]:
    """Path -> (time of change in ns, bytes) of the files below a folder, lock files (``~$name``) left out."""
    system, path, before = _opened(root)
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return {before + (info.path if info.path.startswith("/") else "/" + info.path): (info.mtime_ns, info.size) for info in found
            if info.is_file and fnmatch.fnmatchcase(info.base_name, glob) and not info.base_name.startswith("~$")}


@dataclass
class Ranges(InputPartition):
    """(path, index, count): which ranges of which files a task reads."""

    parts: list[tuple[str, int, int]]


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.glob = options["path"], options.get("pathglobfilter", "*.xlsx")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[InputPartition]:
        """Small files together up to the size of a range, larger ones cut; only the listing is read here.

        A task costs as much as many small files, so of many files more go together, up to ``RANGE_BYTES``.
        """
        tasks, parts, taken = [], [], 0
        files = sorted(listed(self.root, self.glob).items())
        together = max(self.range_bytes, min(RANGE_BYTES, sum(size for _, (_, size) in files) // TASKS))
        for path, (_, size) in files:
            count = max(1, -(-size // self.range_bytes))
            if parts and taken + size > together:
                tasks.append(Ranges(parts))
                parts, taken = [], 0
            if count == 1:
                parts.append((path, 0, 1))
                taken += size
            else:
                tasks += [Ranges([(path, index, count)]) for index in range(count)]
        if parts:
            tasks.append(Ranges(parts))
        if not tasks:
            raise FileNotFoundError(f"no input files below {self.root}")
        return tasks

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        """A small file is read in one go; a larger one through its file system, never held whole."""
        def rows() -> Iterator[tuple]:
            for path, index, count in partition.parts:
                system, own, _ = _opened(path)
                with system.open_input_file(own) as file:
                    yield from _data_rows(path, file.read() if count == 1 and file.size() <= CHUNK else file, index, count)

        return row_batches(rows())


class Workbooks(DataSource):
    """``spark.read.format("workbooks").load(folder)``: raw rows, a task per range of rows. Options: pathGlobFilter, rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def schema(self):
        return RAW_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader({name.lower(): value for name, value in self.options.items()})


def scan_workbooks(spark: SparkSession, root: str, glob: str = "*.xlsx", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``read_workbooks`` for files of any size: rows by file and range of rows, formulas resolved.

    Every task of a file inflates the sheet up to its range, and reads the shared strings; only rows of the range are parsed.
    Sheets of several ranges must be UTF-8 without CDATA sections, as spreadsheet programs write them.
    """
    spark.dataSource.register(Workbooks)
    raw = (spark.read.format("workbooks").option("pathGlobFilter", glob).option("rangeBytes", str(range_bytes))
           .load(qualified(spark, root)))
    return resolve_formulas(raw)


@dataclass
class Entries(InputPartition):
    """One file of the log: the changes of an offset."""

    number: int


class ChangeReader(DataSourceStreamReader):
    """Offset n stands for the first n files of a log, each a list of files new or changed since the one before.

    A log file is written before its offset is handed out, and never again, so a restart sees the same batches.
    """

    def __init__(self, options: dict):
        self.root, self.glob, self.log = options["path"], options.get("pathglobfilter", "*.xlsx"), options["log"]
        self.most = int(options.get("filesperentry", 1000))
        self.seen: dict[str, tuple[int, int]] = {}
        self.number = 0

    def initialOffset(self) -> dict:
        return {"log": 0}

    def _entries(self, number: int) -> list | None:
        system, folder, _ = _opened(self.log)
        path = f"{folder.rstrip('/')}/{number:012d}.json"
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with system.open_input_stream(path) as file:
            return json.loads(file.read())

    def latestOffset(self) -> dict:
        while (entries := self._entries(self.number + 1)) is not None:
            self.seen.update({path: (time, size) for path, time, size in entries})
            self.number += 1
        changed = sorted((time, path, size) for path, (time, size) in listed(self.root, self.glob).items()
                         if self.seen.get(path) != (time, size))
        for start in range(0, len(changed), self.most):
            entries = [(path, time, size) for time, path, size in changed[start:start + self.most]]
            system, folder, _ = _opened(self.log)
            system.create_dir(folder, recursive=True)
            path = f"{folder.rstrip('/')}/{self.number + 1:012d}.json"
            with system.open_output_stream(path + ".new") as file:
                file.write(json.dumps(entries).encode())
            system.move(path + ".new", path)
            self.seen.update({path: (time, size) for path, time, size in entries})
            self.number += 1
        return {"log": self.number}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Entries(number) for number in range(start["log"] + 1, end["log"] + 1)]

    def read(self, partition: Entries) -> Iterator[tuple]:
        yield from (tuple(entry) for entry in self._entries(partition.number) or [])


class ChangedFiles(DataSource):
    """``spark.readStream.format("changed_files")``: (path, changed_ns, length) of files when they are new and whenever they are edited."""

    @classmethod
    def name(cls) -> str:
        return "changed_files"

    def schema(self):
        return "path string, changed_ns bigint, length bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ChangeReader({name.lower(): value for name, value in self.options.items()})


def stream_changed_files(spark: SparkSession, root: str, log: str, glob: str = "*.xlsx", files_per_task: int = 1000) -> DataFrame:
    """New and edited files below a folder as a stream; ``log`` is a shared folder of this stream alone.

    The driver lists the folder for each batch and holds time and size by path, as Spark's own file stream does; it reads no content.
    """
    spark.dataSource.register(ChangedFiles)
    return (spark.readStream.format("changed_files").option("pathGlobFilter", glob).option("log", qualified(spark, log))
            .option("filesPerEntry", str(files_per_task)).load(qualified(spark, root)))
