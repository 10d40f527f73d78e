"""A sink of one's own, as a Spark data source: tasks stage, the driver commits or takes back.

Every task writes a file of its own under ``_staging``, which no reader looks at, and reports its name. When all tasks of a batch
have reported, the driver moves their files into one folder and renames that to ``_batch=<id>``: the rows of all tasks become
visible at once. If the batch fails, the reported files are removed; what a killed task left behind stays invisible. A batch that
was committed before a restart finds its folder and is dropped, so a replay adds nothing.

The rename is atomic on local disks and HDFS; on object stores, where it is a copy, use a table format instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from heliolake.sinks.table import BATCH_COL
from heliolake.sources.custom import file_system, register


@dataclass
class Staged(WriterCommitMessage):
    file: str | None
    rows: int


class _Files:
    """What the batch and the streaming writer share."""

    def __init__(self, path: str, schema):
        self.path, self.schema = path, schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        fs, root = file_system(self.path)
        schema = to_arrow_schema(self.schema)
        name, writer, rows = f"{root}/_staging/{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    if writer is None:
                        fs.create_dir(f"{root}/_staging", recursive=True)
                        writer = pq.ParquetWriter(name, schema, filesystem=fs)
                    writer.write_table(pa.Table.from_batches([batch]).cast(schema))
                    rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Staged(name if writer is not None else None, rows)

    def publish(self, messages: list[Staged | None], batch: str) -> None:
        fs, root = file_system(self.path)
        target = f"{root}/{BATCH_COL}={batch}"
        if fs.get_file_info(target).type != pafs.FileType.NotFound:      # committed before a restart
            self.discard(messages)
            return
        draft = f"{root}/_staging/{uuid.uuid4().hex}"
        fs.create_dir(draft, recursive=True)
        for m in messages:
            if m is not None and m.file:
                fs.move(m.file, f"{draft}/{m.file.rsplit('/', 1)[1]}")
        fs.move(draft, target)

    def discard(self, messages: list[Staged | None]) -> None:
        fs, _ = file_system(self.path)
        for m in messages:
            if m is not None and m.file and fs.get_file_info(m.file).type == pafs.FileType.File:
                fs.delete_file(m.file)


class _StreamWriter(_Files, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, str(batchId))

    def abort(self, messages, batchId: int) -> None:
        self.discard(messages)


class _BatchWriter(_Files, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.publish(messages, uuid.uuid4().hex)

    def abort(self, messages) -> None:
        self.discard(messages)


class CommittedFiles(DataSource):
    """Option ``path``: the table's folder, which the driver and all executors share."""

    @classmethod
    def name(cls) -> str:
        return "heliolake_committed"

    def writer(self, schema, overwrite: bool) -> _BatchWriter:
        if overwrite:
            raise ValueError("the committed sink appends")
        return _BatchWriter(self.options["path"], schema)

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options["path"], schema)


def start_committed(stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Write a stream so that each batch becomes visible as a whole; position and batch ids are the checkpoint's."""
    register(stream.sparkSession, CommittedFiles)
    w = stream.writeStream.format(CommittedFiles.name()).option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def write_committed(df: DataFrame, path: str) -> None:
    """Append a batch; all of it becomes visible at once."""
    register(df.sparkSession, CommittedFiles)
    df.write.format(CommittedFiles.name()).option("path", path).mode("append").save()


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])
