"""Streaming query builders (foreachBatch sinks, fan-out, bounded runs, windowed streams)."""

from __future__ import annotations

import re
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from heliolake.sinks.table import append_batch, batch_written

BatchFn = Callable[[DataFrame, int], None]


def start(stream: DataFrame, sink: BatchFn, checkpoint: str, *, name: str | None = None,
          processing_time: str | None = None, available_now: bool = False,
          output_mode: str = "append") -> StreamingQuery:
    """Run ``sink(batch_df, batch_id)`` per micro-batch.

    ``processing_time`` (e.g. "1 second") is the flush interval; the per-batch size cap is a
    source option (``max_per_trigger``). The checkpoint is this consumer's position: one
    checkpoint per query = one consumer group; the batch is committed only after ``sink``
    returns (at-least-once).
    """
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(output_mode)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_to_end(stream: DataFrame, sink: BatchFn, checkpoint: str, timeout_s: float | None = None,
               output_mode: str = "append") -> StreamingQuery:
    """Process everything available now, then stop (S16's bounded run without a row cap)."""
    q = start(stream, sink, checkpoint, available_now=True, output_mode=output_mode)
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if timeout_s and not finished:
        q.stop()
    if q.exception():
        raise q.exception()
    return q


def bounded_run(stream: DataFrame, sink: BatchFn, checkpoint: str, count: int = 10,
                timeout_s: float = 20.0) -> StreamingQuery:
    """Process at most ``count`` messages or until ``timeout_s``, whichever first."""
    return run_to_end(stream.limit(count), sink, checkpoint, timeout_s)


def fan_out(sinks: Mapping[str, BatchFn]) -> BatchFn:
    """One source, several sinks; the batch is materialised once and shared."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for fn in sinks.values():
                fn(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def split_rejects(good_sink: BatchFn, reject_sink: BatchFn, reject_col: str = "_reject") -> BatchFn:
    """Good rows to the sink, rejected rows (with reason) to a side table."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good_sink(batch.filter(F.col(reject_col).isNull()).drop(reject_col), batch_id)
            reject_sink(batch.filter(F.col(reject_col).isNotNull()), batch_id)
        finally:
            batch.unpersist()
    return run


def fail_on_rejects(sink: BatchFn, reject_col: str = "_reject", told: str | None = None) -> BatchFn:
    """A batch holding any rejected row fails as a whole (nothing of it is written).

    The batch is decoded once; the error counts every reason. With ``told``, a side table, a failing batch first
    appends its counts ``(reject_col, count)`` there; replayed, it is passed over, still without output.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if told and batch_written(batch.sparkSession, told, batch_id):
            return
        batch.persist()
        try:
            counts = batch.filter(F.col(reject_col).isNotNull()).groupBy(reject_col).count()
            reasons = counts.orderBy(reject_col).collect()
            if reasons:
                if told:
                    append_batch(counts, told, batch_id)
                raise ValueError(f"batch {batch_id} has bad rows: " + ", ".join(f"{r[reject_col]} x {r['count']}" for r in reasons))
            sink(batch.drop(reject_col), batch_id)
        finally:
            batch.unpersist()
    return run


def run_past_failures(stream: DataFrame, sink: BatchFn, checkpoint: str) -> list[int]:
    """Run to the end, started again after each batch that fails for bad rows; returns the ids of those batches.

    For ``fail_on_rejects`` with a side table, which passes a failed batch over when it is replayed.
    """
    failed: list[int] = []
    while True:
        try:
            run_to_end(stream, sink, checkpoint)
            return failed
        except Exception as e:  # noqa: BLE001 - only failures for bad rows are gone past, each batch once
            bad = re.search(r"batch (\d+) has bad rows", str(e))
            if not bad or int(bad[1]) in failed:
                raise
            failed.append(int(bad[1]))


def windowed(stream: DataFrame, every: str, fn: str, *, time_col: str, value_col: str,
             series: Sequence[str], lateness: str, order_col: str | None = None) -> DataFrame:
    """Tumbling-window ``last``/``mean`` as a continuous query (emit with ``update`` mode).

    ``lateness`` is the watermark delay: rows older than (max event time - lateness) are
    dropped by Spark and their windows' state is freed; :class:`heliolake.sinks.table.WindowTable` keeps late rows
    instead. The event-time column must be TIMESTAMP.
    """
    src = stream.withWatermark(time_col, lateness).filter(F.col(value_col).isNotNull())
    if fn == "last":
        order = F.struct(F.col(time_col), F.col(order_col)) if order_col else F.col(time_col)
        agg = F.max_by(F.col(value_col), order)
    elif fn == "mean":
        agg = F.avg(F.col(value_col))
    else:
        raise ValueError("fn must be 'last' or 'mean'")
    g = src.groupBy(F.window(F.col(time_col), every).alias("_w"), *series).agg(agg.alias("_value"))
    return g.select(*series, F.col("_w.end").alias("_time"), "_value")


def tap(df: DataFrame, name, *counters) -> DataFrame:
    """Pass rows through unchanged while counting them (and any extra aggregate
    expressions) as metrics of ``name`` (a text, or an ``Observation`` in batch) — read from ``query.lastProgress['observedMetrics']`` in a
    stream or ``Observation.get`` in batch. No second pass, no collect of rows."""
    exprs = [F.count(F.lit(1)).alias("rows"), *counters]
    return df.observe(name, *exprs)


def transform_topic(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], *, out_path: str | None = None,
                    bootstrap: str | None = None, topic: str | None = None, checkpoint: str,
                    available_now: bool = False, processing_time: str | None = None):
    """Stateless topic -> topic transform (``fn`` maps envelope rows to envelope rows with
    ``key``/``value``); Kafka when ``bootstrap`` is given, else a file-backed topic."""
    out = fn(stream)
    if bootstrap:
        w = (out.select("key", "value", *(["headers"] if "headers" in out.columns else [])).writeStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap).option("topic", topic))
    else:
        from heliolake.sources.topic import ENVELOPE_SCHEMA
        cols = [c.split()[0] for c in ENVELOPE_SCHEMA.split(", ")] + (["headers"] if "headers" in out.columns else [])
        out = out if "topic" in out.columns else out.withColumn("topic", F.lit(topic))
        w = out.select(*cols).writeStream.format("parquet").option("path", out_path)
    w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
