"""S5-S11 as streams: the files that arrive in a folder, read by the same readers as a batch.

Spark's file stream tells which files are new (its log in the checkpoint is the position); only their names pass through the
driver, at most ``max_files`` of them a micro-batch. What belongs to a file as a whole, such as a CSV header, the kind of a JSON file or
the state in which a block of it begins, is found inside the micro-batch, so a stream gives what one batch read gives.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from heliolake.sources.files import PRINTER_COLUMNS, MissingSource, _escaped, _qualified, _reader, read_csv, read_json, read_text
from heliolake.streaming.jobs import BatchFn, run_to_end, start

_LISTING = "path string, modificationTime timestamp, length long, content binary"


_SAME = "same"


def _extension(file_format: str, extension: str | None) -> str | None:
    """Files by their format's own extension, unless another is named (None: files of any name)."""
    fmt = (file_format or "none").lower().lstrip(".")
    return (None if fmt == "none" else fmt) if extension == _SAME else extension


def new_files(spark: SparkSession, root: str, file_format: str = "none", *, extension: str | None = _SAME, max_files: int = 1000, max_bytes: int | None = None) -> DataFrame:
    """A stream of the names of new files (``path``); their contents are not read."""
    if not _qualified(spark, root)[1]:
        raise MissingSource(root)
    reader = _reader(spark.readStream.format("binaryFile").schema(_LISTING), _extension(file_format, extension))
    reader = reader.option("maxBytesPerTrigger", int(max_bytes)) if max_bytes else reader.option("maxFilesPerTrigger", int(max_files))
    return reader.load(_escaped(root)).select("path")


def each_batch(root: str, file_format: str, sink: BatchFn, *, extension: str | None = _SAME, columns: Mapping[str, tuple[str, object]] | None = None, schema=None) -> BatchFn:
    """A foreachBatch function over :func:`new_files`: the batch's files, read and handed to ``sink``."""
    fmt, wanted = (file_format or "none").lower().lstrip("."), _extension(file_format, extension)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = [r["path"] for r in batch.collect()]         # bounded by the trigger's limit
        if not names:
            return
        if fmt == "csv":
            rows = read_csv(spark, root, columns or PRINTER_COLUMNS, extension=wanted, files=names)
        elif fmt == "json":
            rows = read_json(spark, root, extension=wanted, schema=schema, files=names)
        else:
            rows = read_text(spark, root, wanted, files=names)
        sink(rows, batch_id)
    return run


def start_folder(spark: SparkSession, root: str, file_format: str, sink: BatchFn, checkpoint: str, *, extension: str | None = _SAME, columns=None, schema=None,
                 max_files: int = 1000, processing_time: str | None = None) -> StreamingQuery:
    """Read new files for ever: ``sink(rows, batch_id)`` for each micro-batch; replayed after a failure, as any foreachBatch."""
    return start(new_files(spark, root, file_format, extension=extension, max_files=max_files),
                 each_batch(root, file_format, sink, extension=extension, columns=columns, schema=schema), checkpoint, processing_time=processing_time)


def read_new(spark: SparkSession, root: str, file_format: str, sink: BatchFn, checkpoint: str, *, extension: str | None = _SAME, columns=None, schema=None,
             max_files: int = 1000) -> StreamingQuery:
    """Read the files that no earlier run with this checkpoint has read, then stop."""
    return run_to_end(new_files(spark, root, file_format, extension=extension, max_files=max_files),
                      each_batch(root, file_format, sink, extension=extension, columns=columns, schema=schema), checkpoint)
