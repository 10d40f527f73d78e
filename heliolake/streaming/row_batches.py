"""A sink gets batches of at most so many rows, or what a trigger's interval has brought, whichever comes first.

A micro-batch is as large as its trigger allows; of files, a single one may hold any number of rows. :class:`RowBatches` stages it once
in files of at most ``rows`` rows (the writing tasks cut them), and hands these to the sink one batch after the other, each under a
number of its own. A batch is marked when the sink returns, so after a failure the replayed micro-batch goes on with the first batch that
is not marked; the staged files are not written again. Rows keep the order of their task from batch to batch.

A batch is a small job, so one after the other leaves most of a cluster idle. A sink whose batches may go out in any order (each to a
place of its own) can take several at once; every batch still has its own call and its own mark.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.streaming.jobs import BatchFn

_FILE = re.compile(r"part-(\d+)-.*[-.]c(\d+)\.")


class _Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path, self._fs = path, self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, *below: str) -> list[str]:
        folder = self._path("/".join([self.path, *below]))
        return [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []

    def text(self, name: str) -> str | None:
        file = self._path(f"{self.path}/{name}")
        if not self._fs.exists(file):
            return None
        stream = self._fs.open(file)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        draft = self._path(f"{self.path}/{name}.draft")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, self._path(f"{self.path}/{name}")):
            raise RuntimeError(f"cannot write {self.path}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


class RowBatches:
    """A foreachBatch function: ``sink(rows, number)`` with at most ``rows`` rows a call; numbers count from 0 without gaps.

    ``folder`` belongs to one consumer, as its checkpoint does. A micro-batch without rows calls no sink. The driver holds the names
    of a micro-batch's staged files. ``at_once`` batches are with the sink at a time; after a failure no more are handed out, and those under way are
    waited for.
    """

    def __init__(self, sink: BatchFn, folder: str, rows: int = 1000, at_once: int = 1):
        if rows < 1 or at_once < 1:
            raise ValueError("rows and at_once must be at least 1")
        self.sink, self.folder, self.rows, self.at_once = sink, folder.rstrip("/"), int(rows), int(at_once)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = _Folder(spark, self.folder)
        plan = self._plan(folder, batch, batch_id)
        done = {n for n in folder.names(f"{batch_id}", "done")}
        failed: list[Exception] = []

        def send(i: int) -> None:
            if failed:
                return
            try:
                rows = spark.read.schema(batch.schema).parquet(*[f"{self.folder}/{batch_id}/rows/{f}" for f in plan["batches"][i]])
                self.sink(rows, plan["first"] + i)
                folder.put(f"{batch_id}/done/{i}", "")
            except Exception as e:  # noqa: BLE001 - raised again when no batch is under way any more
                failed.append(e)

        with ThreadPoolExecutor(self.at_once) as pool:
            list(pool.map(send, [i for i in range(len(plan["batches"])) if str(i) not in done]))
        if failed:
            raise failed[0]

    def _plan(self, folder: _Folder, batch: DataFrame, batch_id: int) -> dict:
        told = folder.text(f"{batch_id}/plan.json")
        if told is not None:
            return json.loads(told)
        earlier = sorted(int(n) for n in folder.names() if n.isdigit() and int(n) < batch_id)
        before = json.loads(folder.text(f"{earlier[-1]}/plan.json") or "{}") if earlier else {}
        if earlier and not before:
            raise RuntimeError(f"micro-batch {earlier[-1]} has no plan")
        staged = f"{self.folder}/{batch_id}/rows"
        batch.write.mode("overwrite").option("maxRecordsPerFile", self.rows).parquet(staged)
        counts = batch.sparkSession.read.schema(batch.schema).parquet(staged).groupBy(F.col("_metadata.file_name").alias("f")).count().collect()
        batches, room = [], 0
        for f, n in sorted(((r["f"], r["count"]) for r in counts), key=lambda x: tuple(map(int, _FILE.match(x[0]).groups()))):
            if n > room:
                batches.append([])
                room = self.rows
            batches[-1].append(f)
            room -= n
        plan = {"first": before["first"] + len(before["batches"]) if before else 0, "batches": batches}
        folder.put(f"{batch_id}/plan.json", json.dumps(plan))
        for n in earlier:                      # these micro-batches are committed; the last one's plan numbers the next
            folder.remove(f"{n}" if n != earlier[-1] else f"{n}/rows")
        return plan
