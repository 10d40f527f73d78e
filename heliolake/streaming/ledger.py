"""T2-T4 for senders: what was delivered is written down chunk by chunk, and a partition that refuses is parked.

Messages of one topic partition go out in offset order, in chunks. After each chunk the task writes its end offset as a small file
of the ledger, so a batch that is replayed after a crash resends nothing that was written down (at most the one chunk that was under
way). A partition whose endpoint still refuses when the policy's waits are used up is *parked*: its remaining messages go to
the ledger's backlog, in Parquet, and the other partitions go on. Later batches send a parked partition's backlog first, in
order, before its new messages; while it refuses, those are added to the backlog.

All state lies under the ledger's folder; nothing is kept in the driver but the parked partitions' numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from heliolake.sources.custom import file_system
from heliolake.streaming.delivery import DeliveryFailed, DeliveryPolicy, deliver

_DONE = "partition int, offset long"


def _mark(path: str, partition: int, offset: int, before: int) -> None:
    """Write down that a partition is delivered through ``offset``; the mark before goes, so one or two stay."""
    fs, root = file_system(path)
    folder = f"{root}/delivered/{partition}"
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/{offset:020d}"):
        pass
    if before >= 0 and fs.get_file_info(f"{folder}/{before:020d}").type == pafs.FileType.File:
        fs.delete_file(f"{folder}/{before:020d}")


def delivered_through(path: str, partition: int) -> int:
    """The last offset of a partition that was written down as delivered, or -1."""
    fs, root = file_system(path)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/delivered/{partition}", allow_not_found=True))
    return max((int(f.base_name) for f in found), default=-1)


class DeliveryLedger:
    """Sends the messages of micro-batches with a record of what went out; one ledger a consumer.

    ``make_sender`` is a picklable factory of a function that takes a list of rows (tuples of ``columns``).
    """

    def __init__(self, spark: SparkSession, path: str, make_sender: Callable[[], Callable[[list], None]], columns: list[str], *,
                 policy: DeliveryPolicy = DeliveryPolicy(), chunk_size: int = 1000):
        self.spark, self.path, self.make_sender, self.columns = spark, path.rstrip("/"), make_sender, list(columns)
        self.policy, self.chunk_size = policy, chunk_size
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, folder: str) -> list[int]:
        """The numbers of complete backlog generations, oldest first."""
        p = self._path(f"{self.path}/{folder}")
        if not self._fs.exists(p):
            return []
        names = [f.getPath() for f in self._fs.listStatus(p) if f.isDirectory()]
        return sorted(int(n.getName().split("=")[1]) for n in names if self._fs.exists(self._path(f"{n.toString()}/_SUCCESS")))

    def backlog(self, schema: StructType) -> DataFrame:
        """The messages of parked partitions that are not delivered yet: the newest generation of the backlog."""
        made = self._folders("backlog")
        return self.spark.read.schema(schema).parquet(f"{self.path}/backlog/batch={made[-1]}") if made else self.spark.createDataFrame([], schema)

    def _send(self):
        path, make_sender, columns, policy, size = self.path, self.make_sender, self.columns, self.policy, self.chunk_size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sender, partition, through, refused, chunk = make_sender(), None, -1, False, []

            def flush() -> None:
                nonlocal refused, through
                if not chunk or refused:
                    chunk.clear()
                    return
                try:
                    deliver(lambda: sender([row for _, row in chunk]), policy)
                    _mark(path, partition, chunk[-1][0], through)
                    through = chunk[-1][0]
                except DeliveryFailed:
                    refused = True
                chunk.clear()

            def told():
                return pa.RecordBatch.from_arrays([pa.array([partition], pa.int32()), pa.array([through], pa.int64())], names=["partition", "offset"])
            try:
                for batch in batches:
                    keys = zip(batch.column("partition").to_pylist(), batch.column("offset").to_pylist())
                    for (p, offset), *row in zip(keys, *[batch.column(c).to_pylist() for c in columns]):
                        if p != partition:
                            if partition is not None:
                                flush()
                                yield told()
                            partition, through, refused = p, delivered_through(path, p), False
                        if offset > through and not refused:
                            chunk.append((offset, tuple(row)))
                            if len(chunk) >= size:
                                flush()
                if partition is not None:
                    flush()
                    yield told()
            finally:
                close = getattr(sender, "close", None)
                if callable(close):
                    close()
        return run

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """Send one micro-batch (foreachBatch): ``partition``, ``offset`` and the sender's columns.

        A partition is one task's work while it is sent, as order asks. What was refused is the next backlog; the batch
        is done when that is written, so its messages are in the ledger whatever happens later.
        """
        made = self._folders("backlog")
        if made and made[-1] >= batch_id:
            return                                   # the batch was finished before the restart
        wanted = batch.select(F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"),
                              *[c for c in self.columns if c not in ("partition", "offset")])
        schema = StructType([StructField(f.name, f.dataType) for f in wanted.schema.fields])
        waiting = self.backlog(schema).unionByName(wanted)
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)
        sent = (waiting.repartition(tasks, "partition").sortWithinPartitions("partition", "offset")
                .mapInArrow(self._send(), StructType([StructField("partition", IntegerType()), StructField("offset", LongType())])))
        ends = f"{self.path}/ends/batch={int(batch_id)}"
        sent.write.mode("overwrite").parquet(ends)   # sending happens here, once, unless a task is lost
        done = self.spark.read.schema(_DONE).parquet(ends).groupBy("partition").agg(F.max("offset").alias("_through"))
        left = waiting.join(done, "partition", "left").where(F.col("_through").isNull() | (F.col("offset") > F.col("_through")))
        left.select(*schema.names).write.mode("overwrite").parquet(f"{self.path}/backlog/batch={int(batch_id)}")
        for old in made[:-1]:                        # the newest but one stays for a reader that has begun
            self._fs.delete(self._path(f"{self.path}/backlog/batch={old}"), True)
            self._fs.delete(self._path(f"{self.path}/ends/batch={old}"), True)

    def parked(self, schema: StructType) -> DataFrame:
        """``partition, from_offset, messages`` of the partitions that wait."""
        return self.backlog(schema).groupBy("partition").agg(F.min("offset").alias("from_offset"), F.count(F.lit(1)).alias("messages"))
