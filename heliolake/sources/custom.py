"""A source of one's own, as a Spark data source: batch and stream, read by many tasks, restart-safe.

A subclass of :class:`LogSource` says what a log consists of: ``ends()`` gives the length of each of its parts (on the driver), and
``records(part, start, end)`` reads a range of one (in a task). Splitting ranges over tasks, offsets, restarts and
replays are Spark's: an offset is the length of every part so far, kept in the query's checkpoint, so each record is read once.

:class:`ParquetLog` reads Parquet files in this way; files may be added while it runs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

#: Records that one task reads, unless the option ``rows_per_task`` says otherwise.
ROWS_PER_TASK = 1_000_000


def register(spark: SparkSession, source: type[DataSource]) -> None:
    """Make a data source known to the session. Its classes travel by value, since the process that plans a streaming source
    sees no added Python files."""
    for cls in source.__mro__:
        module = sys.modules.get(cls.__module__)
        if module is not None and cls.__module__.split(".")[0] not in ("builtins", "abc", "pyspark"):
            cloudpickle.register_pickle_by_value(module)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(source)


class Range(InputPartition):
    def __init__(self, part: str, start: int, end: int):
        self.part, self.start, self.end = part, start, end


class LogSource(DataSource):
    """Subclasses give ``name()``, ``schema()``, ``ends()`` and ``records()``."""

    def ends(self) -> dict[str, int]:
        raise NotImplementedError

    def records(self, part: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        """The records between two offsets, cut for tasks."""
        step = int(self.options.get("rows_per_task", ROWS_PER_TASK))
        return [Range(part, at, min(at + step, n)) for part, n in sorted(end.items()) for at in range(start.get(part, 0), n, step)]

    def reader(self, schema) -> "LogReader":
        return LogReader(self)

    def streamReader(self, schema) -> "LogStreamReader":
        return LogStreamReader(self)


class LogReader(DataSourceReader):
    def __init__(self, log: LogSource):
        self.log = log

    def partitions(self) -> list[Range]:
        # an empty log still needs a partition to be asked for
        return self.log.ranges({}, self.log.ends()) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.end > partition.start:
            yield from self.log.records(partition.part, partition.start, partition.end)


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, log: LogSource):
        self.log = log

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self, *_) -> dict:
        return self.log.ends()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.log.ranges(start, end) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.end > partition.start:
            yield from self.log.records(partition.part, partition.start, partition.end)

    def commit(self, end: dict) -> None:
        """Nothing to let go of: the log keeps its records."""


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


class ParquetLog(LogSource):
    """Options: ``path`` (a file or folder), ``rows_per_task``. Parts are files, records are rows."""

    @classmethod
    def name(cls) -> str:
        return "heliolake_log"

    def _files(self) -> list[str]:
        fs, path = file_system(self.options["path"])
        if fs.get_file_info(path).type == pafs.FileType.File:
            return [path]
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        hidden = [f for f in found if any(p[:1] in "._" and "=" not in p for p in f.path[len(path):].strip("/").split("/"))]
        return sorted(f.path for f in found if f.type == pafs.FileType.File and f not in hidden)

    def _open(self, file: str) -> pq.ParquetFile:
        return pq.ParquetFile(file_system(self.options["path"])[0].open_input_file(file))

    def schema(self):
        files = self._files()
        if not files:
            raise FileNotFoundError(f"no file in {self.options['path']} to take the schema from; give one with .schema()")
        return from_arrow_schema(self._open(files[0]).schema_arrow, prefer_timestamp_ntz=True)

    def ends(self) -> dict[str, int]:
        return {f: self._open(f).metadata.num_rows for f in self._files()}

    def records(self, part: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        file, first = self._open(part), 0
        for group in range(file.metadata.num_row_groups):
            n = file.metadata.row_group(group).num_rows
            if first < end and first + n > start:
                at = first
                for batch in file.iter_batches(row_groups=[group]):
                    low, high = max(start - at, 0), min(end - at, batch.num_rows)
                    if low < high:
                        yield batch.slice(low, high - low)
                    at += batch.num_rows
            first += n


def read_log(spark: SparkSession, path: str, *, stream: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A :class:`ParquetLog` as a DataFrame."""
    register(spark, ParquetLog)
    return (spark.readStream if stream else spark.read).format(ParquetLog.name()).option("path", path).option("rows_per_task", rows_per_task).load()
