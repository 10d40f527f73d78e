"""Folder streams, custom sources and sinks, and sinks whose columns follow the input, over the driver tables."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.plans.registry import register
from heliolake.session import unique_dir
from heliolake.sinks.committed import read_committed, start_committed
from heliolake.sinks.table import append_batch
from heliolake.sinks.widening import WideningTable
from heliolake.sources.custom import file_system, read_log
from heliolake.sources.topic import as_topic, read_topic, write_topic
from heliolake.streaming import folders, jobs
from heliolake.streaming.delivery import Backpressure, DeliveryPolicy
from heliolake.streaming.ledger import DeliveryLedger
from heliolake.tables import table


@register("folder_stream", "S5 S6 S7 S8a S8c S9 S11 S16", oracle="""
SELECT 'json' AS kind, event_id AS id, event_type AS name, value, 'half=' || event_id % 2 AS folder FROM events
UNION ALL SELECT 'csv', c_custkey, c_name || chr(10) || '"' || c_mktsegment || '"', c_acctbal, 'half=' || c_custkey % 2 FROM customer
UNION ALL SELECT 'text', NULL, n_name, NULL, 'half=' || n_nationkey % 2 FROM nation
""")
def folder_stream(spark: SparkSession, root: str) -> DataFrame:
    """JSON arrays and lines, CSV with line breaks in quotes, and text, arriving in a folder in two halves; a stream of each kind is stopped after
    the first and started again. Every record is read once, with its file's name."""
    ev = table(spark, root, "events").select("event_id", "event_type", "value", (F.col("event_id") % 2).alias("half"))
    cu = table(spark, root, "customer").select("c_custkey", F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('"')).alias("c_name"), "c_acctbal", (F.col("c_custkey") % 2).alias("half"))
    na = table(spark, root, "nation").select(F.concat(F.lit("  "), "n_name", F.lit(" \r")).alias("value"), (F.col("n_nationkey") % 2).alias("half"))
    out = None
    names = "event_id bigint, event_type string, value double"
    columns = {"c_custkey": ("bigint", 0), "c_name": ("string", ""), "c_acctbal": ("double", 0.0)}
    shapes = {
        "json": lambda d: d.filter("_reject IS NULL").select(F.from_json("value", names).alias("r"), "source_file").select("r.event_id", "r.event_type", "r.value", "source_file"),
        "csv": lambda d: d.filter("_reject IS NULL").select(*columns, "source_file"),
        "txt": lambda d: d.select(F.lit(None).cast("long"), "content", F.lit(None).cast("double"), "source_file")}
    for kind, shape in shapes.items():
        path, sink, checkpoint = (unique_dir(spark, f"folder_stream_{x}") for x in ("in", "out", "ckpt"))

        def write(rows: DataFrame, batch_id: int, shape=shape, sink=sink) -> None:
            append_batch(shape(rows).toDF("id", "name", "value", "source_file"), sink, batch_id)

        for half in (0, 1):
            if kind == "json":
                part = ev.where(F.col("half") == half)
                if half:
                    part.write.mode("append").partitionBy("half").json(path)
                else:
                    rows = part.groupBy("half", F.expr("event_id div 16384").alias("chunk")).agg(F.to_json(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("value"))
                    # one array a file
                    rows.repartition("chunk").select("half", "value").write.mode("append").option("maxRecordsPerFile", 1).partitionBy("half").text(path)
            elif kind == "csv":
                cu.where(F.col("half") == half).write.mode("append").option("header", "true").option("escape", '"').partitionBy("half").csv(path)
            else:
                na.where(F.col("half") == half).write.mode("append").partitionBy("half").text(path)
            # the two kinds of JSON files have different extensions
            folders.read_new(spark, path, kind, write, checkpoint, extension=None if kind == "json" else kind, columns=columns)
        found = spark.read.parquet(sink).select(F.lit("text" if kind == "txt" else kind).alias("kind"), "id", "name", "value", F.regexp_extract("source_file", "^(.*)/[^/]+$", 1).alias("folder"))
        out = found if out is None else out.unionByName(found)
    return out


@register("custom_source", "X3 S1 S3", oracle="""
SELECT how, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders, (VALUES ('batch'), ('stream')) AS h(how)
""")
def custom_source(spark: SparkSession, root: str) -> DataFrame:
    """orders through a Python data source: in a batch, and as a stream whose files come in two lots with a restart between them."""
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path, sink, checkpoint = (unique_dir(spark, f"custom_source_{x}") for x in ("in", "out", "ckpt"))
    orders = table(spark, root, "orders").select(*columns)
    for lot in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == lot).write.mode("append").parquet(path)
        q = (read_log(spark, path, stream=True, rows_per_task=100_000).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    batch = read_log(spark, path, rows_per_task=100_000)
    return batch.select(F.lit("batch").alias("how"), *columns).unionByName(spark.read.parquet(sink).select(F.lit("stream").alias("how"), *columns))


@register("custom_sink", "X4 K11 T2 T12", oracle="SELECT event_id, event_type, value, ts, 3 AS batches FROM events")
def custom_sink(spark: SparkSession, root: str) -> DataFrame:
    """events as a stream of three files, a batch each, through a sink that commits on the driver; what is visible is whole batches."""
    path, sink, checkpoint = (unique_dir(spark, f"custom_sink_{x}") for x in ("in", "out", "ckpt"))
    ev = table(spark, root, "events").select("event_id", "event_type", "value", "ts")
    for i in range(3):
        ev.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    start_committed(stream, sink, checkpoint, available_now=True).awaitTermination()
    seen = spark.read.parquet(sink).select("_batch").distinct().agg(F.count(F.lit(1)).cast("int").alias("batches"))
    return read_committed(spark, sink, ev.schema).select("*", seen.scalar().alias("batches"))


@register("widening_sink", "U3 K2 K4 P6", oracle="""
SELECT event_id AS "offset", CASE WHEN event_id % 2 = 0 THEN trunc(value) ELSE value END AS reading, event_type AS kind,
       CASE WHEN event_id % 2 = 1 THEN user_id END AS panel, CASE WHEN event_id % 2 = 1 AND value IS NOT NULL THEN value > 50 END AS high,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 7 AS VARCHAR) ELSE 'code ' || event_id % 7 END AS code FROM events
""")
def widening_sink(spark: SparkSession, root: str) -> DataFrame:
    """A stream of JSON payloads in two batches: the second has two new fields, fractions where the first had integers, and texts
    where it had numbers. The sink's columns follow; rows of the first batch are NULL in the new ones."""
    path, sink, checkpoint = (unique_dir(spark, f"widening_{x}") for x in ("topic", "out", "ckpt"))
    ev = table(spark, root, "events")
    code = F.col("event_id") % 7
    first = F.to_json(F.struct(F.col("value").cast("long").alias("reading"), F.col("event_type").alias("kind"), code.alias("code")))
    second = F.to_json(F.struct(F.col("value").alias("reading"), F.col("event_type").alias("kind"), F.col("user_id").alias("panel"), (F.col("value") > 50).alias("high"),
                                F.concat(F.lit("code "), code.cast("string")).alias("code")))
    found = WideningTable(spark, sink)
    for half, value in ((0, first), (1, second)):
        write_topic(as_topic(ev.where(F.col("event_id") % 2 == half), key=F.col("user_id"), value=value, topic="open", offset=F.col("event_id")), path=path)
        jobs.run_to_end(read_topic(spark, "open", path=path), lambda batch, i: found.append_json(batch, i, keep=["offset"]), checkpoint)
    return found.read().select("offset", "reading", "kind", "panel", "high", "code")


class FileEndpoint:
    """An endpoint that keeps what it is sent, a file a call, and refuses one partition while a file named ``busy`` is there."""

    def __init__(self, path: str, busy: str, refused: int):
        self.path, self.busy, self.refused = path, busy, refused

    def __call__(self, rows: list) -> None:
        fs, root = file_system(self.path)
        if rows[0][0] == self.refused and fs.get_file_info(file_system(self.busy)[1]).is_file:
            raise Backpressure(0.0, "busy")
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}.json") as f:
            at, call = time.time_ns(), uuid.uuid4().hex
            f.write("".join(json.dumps({"partition": p, "offset": o, "kind": k, "at": at, "call": call}) + "\n" for p, o, k in rows).encode())


@register("delivery_ledger", "T2 T3 T4 K8", oracle="""
WITH e AS (SELECT event_id AS "offset", CAST(user_id % 8 AS INTEGER) AS partition, event_type AS kind, (event_id * 3) // (SELECT max(event_id) + 1 FROM events) AS lot FROM events)
SELECT "offset", partition, kind, true AS in_order, CASE WHEN partition = 3 OR lot = 2 THEN 1 ELSE 0 END AS run FROM e
""")
def delivery_ledger(spark: SparkSession, root: str) -> DataFrame:
    """A topic of eight partitions in three batches to an endpoint that refuses one of them during the first two: the others go out, the
    parked one follows when the endpoint takes it, and every partition arrives once and in order."""
    path, sink, ledger, checkpoint, busy = (unique_dir(spark, f"ledger_{x}") for x in ("topic", "endpoint", "ledger", "ckpt", "busy"))
    ev = table(spark, root, "events").select("event_id", (F.col("user_id") % 8).cast("int").alias("partition"), F.col("event_type").alias("kind"))
    most = ev.agg((F.max("event_id") + 1).alias("n")).first()["n"] or 1
    lots = ev.withColumn("lot", F.expr(f"(event_id * 3) div {most}"))
    fs, busy_path = file_system(busy)
    fs.create_dir(busy_path, recursive=True)
    mark = f"{busy_path}/busy"
    with fs.open_output_stream(mark):
        pass
    policy = DeliveryPolicy(backpressure_wait_s=0.0, max_backpressure_waits=2)
    for run, wanted in ((0, (0, 1)), (1, (2,))):
        endpoint, busy_file = f"{sink}/run={run}", f"{busy}/busy"
        out = DeliveryLedger(spark, ledger, lambda e=endpoint, b=busy_file: FileEndpoint(e, b, 3), ["partition", "offset", "kind"], policy=policy, chunk_size=500)
        for lot in wanted:
            rows = lots.where(F.col("lot") == lot)
            write_topic(as_topic(rows, key="kind", value=F.col("kind"), topic="out", partition=F.col("partition"), offset=F.col("event_id")), path=path)
            jobs.run_to_end(read_topic(spark, "out", path=path), lambda b, i, out=out: out.deliver(b.select("partition", "offset", F.col("value").alias("kind")), i), checkpoint)
        if fs.get_file_info(mark).is_file:
            fs.delete_file(mark)
    got = spark.read.schema("partition int, offset long, kind string, at long, call string, run int").json(sink)
    # the calls of a partition, one row for 500 messages, by time: each begins behind the one before
    calls = got.groupBy("partition", "run", "at", "call").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    times = calls.groupBy("partition").agg(F.sort_array(F.collect_list(F.struct("run", "at", "low", "high"))).alias("c"))
    behind = F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: a["high"] < b["low"])
    return got.join(times.select("partition", F.forall(behind, lambda x: x).alias("in_order")), "partition").select("offset", "partition", "kind", "in_order", "run")
