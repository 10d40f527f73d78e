"""W2 as keyed streaming state: the first reading of every key, found as rows stream by in any order.

State is one value per key, held by Spark's state store. A run that ends by itself keeps its states, as a streaming aggregation: a batch's
rows are combined per key in their tasks, before they meet their state. A query that runs for ever frees a state when its key has been idle
for ``idle_ms``; there a key's rows are spread over ``salts`` states, so that a key with a large share of all rows is not one task's work.
A state's first second is emitted whenever it falls (an aggregation emits it with each batch of the key), and a keyed table keeps the
least of each key: that is the answer of one batch over all rows, whatever the order of arrival, the restarts in between and the states freed. Rows
without a time count for nothing; a NULL key is a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from heliolake.sinks.table import BATCH_COL, KeyedTable
from heliolake.streaming.jobs import run_to_end, start

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSecond(StatefulProcessor):
    """The least second of a key so far; emitted when it falls."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", StructType([StructField("second", LongType())]), *([self.idle_ms] if self.idle_ms else []))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.first.get()[0] if self.first.exists() else None
        least = min(int(part["second"].min()) for part in rows)
        new = held is None or least < held
        # written again with every batch of the key: its time to live starts anew
        self.first.update((least if new else held,))
        if new:
            yield pd.DataFrame({"key": pd.Series([key[0]], dtype=object), "second": [least]})

    def close(self) -> None:
        pass


def first_seconds(stream: DataFrame, key: str, time_col: str, *, idle_ms: int | None = None, salts: int = 16) -> DataFrame:
    """``(key, second)``: a key's first second, each time it falls (with ``idle_ms``: of each of its ``salts`` states).

    ``idle_ms`` is the time to live of a state that gets no rows; None keeps it. With it Spark plans batches without
    rows for as long as the query runs, so a run that ends by itself cannot have it.
    """
    kind = stream.schema[key].dataType
    rows = stream.select(F.col(key).alias("key"), F.unix_seconds(F.col(time_col).cast("timestamp")).alias("second"))
    rows = rows.filter(F.col("second").isNotNull())
    if idle_ms is None:
        return rows.groupBy("key").agg(F.min("second").alias("second"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("second"), F.lit(salts)).cast("int"))
    out = StructType([StructField("key", kind), StructField("second", LongType())])
    return rows.groupBy("key", "salt").transformWithStateInPandas(FirstSecond(idle_ms), out, "Update", "ProcessingTime" if idle_ms else "None")


class KeyAges:
    """The first readings of a stream's keys, kept under ``path``."""

    def __init__(self, path: str):
        self.table = KeyedTable(path, ["_key"], [], combine=lambda d: d.groupBy("_key").agg(F.min("second").alias("second"), F.max(BATCH_COL).alias(BATCH_COL)))

    def run_to_end(self, stream: DataFrame, key: str, time_col: str, checkpoint: str, *, salts: int = 16) -> StreamingQuery:
        """Take in what the stream has now, then stop."""
        return self._with_store(stream, lambda: run_to_end(self._firsts(stream, key, time_col, None, salts), self._keep, checkpoint, output_mode="update"))

    def start(self, stream: DataFrame, key: str, time_col: str, checkpoint: str, *, idle_ms: int = 7 * 86_400_000, salts: int = 16,
              processing_time: str | None = None) -> StreamingQuery:
        """Run for ever; a state without rows for ``idle_ms`` is freed."""
        return self._with_store(stream, lambda: start(self._firsts(stream, key, time_col, idle_ms, salts), self._keep, checkpoint,
                                                      processing_time=processing_time, output_mode="update"))

    @staticmethod
    def _firsts(stream: DataFrame, key: str, time_col: str, idle_ms: int | None, salts: int) -> DataFrame:
        return first_seconds(stream, key, time_col, idle_ms=idle_ms, salts=salts).select(F.struct("key").alias("_key"), "second")

    @staticmethod
    def _with_store(stream: DataFrame, go: Callable[[], StreamingQuery]) -> StreamingQuery:
        """Keyed state needs RocksDB; the session's own choice comes back when the query has started."""
        conf = stream.sparkSession.conf
        before = conf.get(_PROVIDER, None)
        conf.set(_PROVIDER, ROCKSDB)
        try:
            return go()
        finally:
            if before is None:
                conf.unset(_PROVIDER)
            else:
                conf.set(_PROVIDER, before)

    def _keep(self, firsts: DataFrame, batch_id: int) -> None:
        """A batch without rows, which a query with a time to live has many of, adds nothing to the table."""
        firsts.persist()             # states are read and written once a batch, whatever the table does with the rows
        try:
            if not firsts.isEmpty():
                self.table.upsert(firsts, batch_id)
        finally:
            firsts.unpersist()

    def firsts(self) -> DataFrame:
        return self.table.read().select("_key.key", "second")

    def ages(self, rows: DataFrame, key: str, time_col: str, out: str = "age_s") -> DataFrame:
        """Seconds since the first reading of each row's key."""
        first = self.firsts().toDF("_first_key", "_first_s")
        secs = F.unix_seconds(F.col(time_col).cast("timestamp"))
        return (rows.join(first, F.col(key).eqNullSafe(F.col("_first_key")), "left")
                .withColumn(out, secs - F.col("_first_s")).drop("_first_s", "_first_key"))
