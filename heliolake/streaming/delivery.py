"""Delivery to external endpoints: retry, backpressure, transient-error classification, and
a batch ledger for at-least-once sinks.

Spark gives at-least-once: a micro-batch is committed to the checkpoint only after
``foreachBatch`` returns, so a failure replays it. Inside a batch each partition task sends its
own rows in chunks (one client per task); a chunk is retried ``attempts`` times with a fixed
wait, a backpressure signal waits longer (capped), and then the task fails — Spark's task retry
and, beyond that, the query failure + restart from the checkpoint resend the data.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field
from typing import Callable, Iterable, Sequence


class Backpressure(Exception):
    """The endpoint asks us to slow down (quota / rate limit / busy)."""

    def __init__(self, retry_after: float = 30.0, message: str = "backpressure"):
        super().__init__(message)
        self.retry_after = retry_after


class DeliveryFailed(RuntimeError):
    """All attempts failed; raised so the task (and then the micro-batch) fails."""


def is_transient(exc: BaseException) -> bool:
    """T5: an error is a rate/quota signal when its text has the word 'quota' or 'rate' (or one of their forms), not when
    another word happens to hold those letters."""
    return re.search(r"\b(quotas?|rates?|rate[-_ ]?limit\w*)\b", str(exc), re.IGNORECASE) is not None


@dataclass(frozen=True)
class DeliveryPolicy:
    """``attempts`` tries ``retry_wait_s`` apart for connection errors; backpressure
    waits ``backpressure_wait_s``, at most ``max_backpressure_waits`` times in a row (None: without bound)."""

    attempts: int = 3
    retry_wait_s: float = 3.0
    backpressure_wait_s: float = 30.0
    max_backpressure_waits: int | None = 120
    retry_on: tuple = (ConnectionError,)
    classify: Callable[[BaseException], bool] = field(default=is_transient)


def deliver(send: Callable[[], None], policy: DeliveryPolicy, sleep: Callable[[float], None] = time.sleep) -> int:
    """Call ``send`` until it succeeds; return the number of calls made."""
    calls = 0
    failures = 0
    waits = 0
    while True:
        calls += 1
        try:
            send()
            return calls
        except Backpressure as bp:
            waits += 1
            if policy.max_backpressure_waits is not None and waits > policy.max_backpressure_waits:
                raise DeliveryFailed(f"still backpressured after {waits - 1} waits") from bp
            sleep(min(bp.retry_after, policy.backpressure_wait_s) if bp.retry_after else policy.backpressure_wait_s)
        except policy.retry_on as e:  # type: ignore[misc]
            failures += 1
            if failures >= policy.attempts:
                raise DeliveryFailed(f"failed after {failures} attempts: {e}") from e
            sleep(policy.retry_wait_s)
        except Exception as e:  # noqa: BLE001
            if policy.classify(e):
                waits += 1
                if policy.max_backpressure_waits is not None and waits > policy.max_backpressure_waits:
                    raise DeliveryFailed(f"still rate limited after {waits - 1} waits: {e}") from e
                sleep(policy.backpressure_wait_s)
            else:
                raise


def send_partitions(df, make_sender: Callable[[], Callable[[list], None]], columns: Sequence[str],
                    policy: DeliveryPolicy = DeliveryPolicy(), chunk_size: int = 1000) -> None:
    """Per partition, build one sender (client) and send rows in chunks with
    ``deliver``. ``make_sender`` is a picklable factory; the sender takes a list of tuples."""
    cols = list(columns)

    def run(rows: Iterable) -> None:
        sender = make_sender()
        try:
            chunk: list = []
            for r in rows:
                chunk.append(tuple(r[c] for c in cols))
                if len(chunk) >= chunk_size:
                    batch = chunk
                    deliver(lambda: sender(batch), policy)
                    chunk = []
            if chunk:
                deliver(lambda: sender(chunk), policy)
        finally:
            close = getattr(sender, "close", None)
            if callable(close):
                close()

    df.select(*cols).foreachPartition(run)


def deliveries(df, make_sender: Callable[[], Callable[[list], None]], columns: Sequence[str],
               policy: DeliveryPolicy = DeliveryPolicy(), chunk_size: int = 1000):
    """Like :func:`send_partitions`, as a DataFrame: the delivered records with ``calls``, how often their
    chunk was sent. Sending happens where the result is computed, so it is read once (or stored)."""
    import pyarrow as pa
    from pyspark.sql.types import IntegerType, StructField, StructType

    cols = list(columns)
    sent = df.select(*cols)

    def run(batches):
        sender = make_sender()
        try:
            for batch in batches:
                rows = list(zip(*[batch.column(c).to_pylist() for c in cols]))
                calls: list[int] = []
                for i in range(0, len(rows), chunk_size):
                    chunk = rows[i:i + chunk_size]
                    calls += [deliver(lambda: sender(chunk), policy)] * len(chunk)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(calls, pa.int32())], names=[*cols, "calls"])
        finally:
            close = getattr(sender, "close", None)
            if callable(close):
                close()

    return sent.mapInArrow(run, StructType([*sent.schema.fields, StructField("calls", IntegerType())]))


class BatchLedger:
    """``(query, batch_id)`` markers on shared storage: a batch already delivered by an append
    sink is skipped when Spark replays it (crash between the write and the checkpoint commit)."""

    def __init__(self, spark, path: str):
        self._spark = spark
        self.path = path.rstrip("/")

    def _fs_path(self, batch_id: int):
        jvm = self._spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch-{int(batch_id):012d}")
        return p, p.getFileSystem(self._spark._jsc.hadoopConfiguration())

    def done(self, batch_id: int) -> bool:
        p, fs = self._fs_path(batch_id)
        return bool(fs.exists(p))

    def mark(self, batch_id: int) -> None:
        p, fs = self._fs_path(batch_id)
        fs.create(p, True).close()
