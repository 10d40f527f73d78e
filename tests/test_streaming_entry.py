import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from heliolake.plans.readings import TOPIC, readings_topic
from heliolake.sources.topic import read_topic, write_topic
from heliolake.streaming import jobs
from heliolake.operators.codec import Field, decode, good_rows, REJECT
from heliolake.operators.windows import aggregate_window
from heliolake.functions.timefn import event_time

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["location_id", "_time", "_value"] and df.count() > 0


def test_every_query_has_oracle_or_is_declared(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 39


@pytest.mark.parametrize("name", ["window_last", "decode_lookups", "sink_rows_23", "upsert_latest",
                                  "text_lines", "dimension_lookup"])
def test_queries_match_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ["events", "customer", "nation", "region", "documents", "lineitem", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)


def _topic(spark, scratch, edge=False):
    path = os.path.join(scratch, "topic")
    write_topic(readings_topic(spark, SF, edge=edge).repartition(4, "partition"), path=path)
    return path


def test_batch_equals_stream_window(spark, scratch):
    path = _topic(spark, scratch)
    fields = [Field("location_id"), Field("power_output", "double"), Field("timestamp", "long")]

    def prep(df):
        d = good_rows(decode(df.withColumn("_ms", F.unix_millis("timestamp")), fields, keep=["offset", "_ms"]))
        return d.withColumn("_time", event_time("timestamp", "_ms", "broker"))

    batch = aggregate_window(prep(read_topic(spark, TOPIC, path=path, stream=False)), "1 hour", "last",
                             series=["location_id"], time_col="_time", value_col="power_output", order_col="offset")
    stream = jobs.windowed(prep(read_topic(spark, TOPIC, path=path, stream=True, max_per_trigger=1)), "1 hour", "last",
                           time_col="_time", value_col="power_output", series=["location_id"], lateness="40 days",
                           order_col="offset")
    from heliolake.sinks.table import KeyedTable
    kt = KeyedTable(os.path.join(scratch, "kt"), ["location_id", "_time"], [])
    jobs.run_to_end(stream, lambda b, i: kt.upsert(b, i), os.path.join(scratch, "ck"), output_mode="update")
    a = sorted((r.location_id, r._time, r._value) for r in batch.collect())
    b = sorted((r.location_id, r._time, r._value) for r in kt.read().collect())
    assert a == b and len(a) > 0


def test_restart_from_checkpoint_sends_nothing_new(spark, scratch):
    path = _topic(spark, scratch)
    seen = []
    stream = read_topic(spark, TOPIC, path=path, stream=True, max_per_trigger=2)
    ck = os.path.join(scratch, "ck2")
    jobs.run_to_end(stream, lambda b, i: seen.append((i, b.count())), ck)
    first = sum(n for _, n in seen)
    jobs.run_to_end(read_topic(spark, TOPIC, path=path, stream=True), lambda b, i: seen.append((i, b.count())), ck)
    assert first == 1000 and sum(n for _, n in seen) == first


def test_failing_batch_is_replayed(spark, scratch):
    path = _topic(spark, scratch)
    ck = os.path.join(scratch, "ck3")
    calls = []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise ConnectionError("sink down")

    with pytest.raises(Exception):
        jobs.run_to_end(read_topic(spark, TOPIC, path=path, stream=True, max_per_trigger=2), flaky, ck)
    jobs.run_to_end(read_topic(spark, TOPIC, path=path, stream=True, max_per_trigger=2), flaky, ck)
    assert calls[0] == calls[1] == 0      # the failed batch is sent again after restart


def test_fail_policy_and_bounded_run(spark, scratch):
    path = _topic(spark, scratch, edge=True)
    from heliolake.operators.layouts import shape_relational
    rows = shape_relational(read_topic(spark, TOPIC, path=path, stream=True))
    with pytest.raises(Exception, match="bad rows"):
        jobs.run_to_end(rows, jobs.fail_on_rejects(lambda b, i: None), os.path.join(scratch, "ck4"))
    got = []
    jobs.bounded_run(read_topic(spark, TOPIC, path=path, stream=True), lambda b, i: got.append(b.count()),
                     os.path.join(scratch, "ck5"), count=10, timeout_s=60)
    assert sum(got) == 10


def test_fail_policy_counts_every_batch(spark, scratch, monkeypatch):
    from heliolake.operators.layouts import shape_relational
    from heliolake.plans import streams
    path = os.path.join(scratch, "batches")
    rows = readings_topic(spark, SF, edge=True)
    clean = shape_relational(rows, keep=["offset"]).filter(F.col(REJECT).isNull()).select("offset").limit(50)
    write_topic(rows.join(clean, "offset", "left_semi").coalesce(1), path=path)      # read first
    write_topic(rows.join(clean, "offset", "left_anti").repartition(3), path=path)
    monkeypatch.setattr(streams, "TRIGGER_BYTES", 1)
    monkeypatch.setattr(streams, "produce_topic", lambda *a, **k: path)
    got = {r["reason"]: r["n"] for r in streams.stream_fail_policy(spark, SF).collect()}
    want = shape_relational(rows, keep=["offset"]).filter(F.col(REJECT).isNotNull()).groupBy(REJECT).count().collect()
    assert got == {r[REJECT]: r["count"] for r in want} and len(got) > 1


def test_tap_counts_without_collect(spark):
    from pyspark.sql import Observation
    obs = Observation("tap")
    df = spark.range(100).observe(obs, F.count(F.lit(1)).alias("rows"), F.sum("id").alias("total"))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 100, "total": 4950}
    tapped = jobs.tap(spark.range(5), "t")
    assert tapped.count() == 5


def test_apply_defaults_keeps_cluster_settings(spark):
    from heliolake.session import apply_defaults
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    apply_defaults(spark)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_watermark_drops_late_rows_append_mode(spark, scratch):
    """Append mode emits a window once the watermark passes its end; a row older than the
    watermark arriving later is dropped (bounded state)."""
    src = os.path.join(scratch, "late_src")
    schema = "t timestamp, s string, v double"

    def arrive(rows, name):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(os.path.join(src, name))

    import datetime as dt
    T = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    arrive([(T(0, 10), "a", 1.0), (T(0, 50), "a", 3.0)], "p1")
    out = []

    def sink(b, i):
        out.extend((r.s, r._time, r._value) for r in b.collect())

    ck = os.path.join(scratch, "ck_late")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        agg = jobs.windowed(stream, "1 hour", "mean", time_col="t", value_col="v", series=["s"], lateness="30 minutes")
        jobs.run_to_end(agg, sink, ck, output_mode="append")

    run()
    assert out == []                                   # window [00:00, 01:00) still open
    arrive([(T(2, 0), "a", 5.0)], "p2")                # watermark -> 01:30: first window final
    run()
    arrive([(T(0, 20), "a", 100.0)], "p3")             # late for a closed window: dropped
    run()
    assert (("a", T(1), 2.0) in out) and all(v != 100.0 for _, _, v in out)


def test_headers_on_file_backed_topic(spark, scratch):
    """Message headers travel with a file-backed topic and are visible to a transform."""
    path = os.path.join(scratch, "hdr_topic")
    from heliolake.sources.topic import as_topic
    src = spark.createDataFrame([("PARIS", '{"a":1}', 1)], "k string, v string, o long")
    hdr = F.array(F.struct(F.lit("trace").alias("key"), F.encode(F.lit("t-1"), "UTF-8").alias("value")))
    write_topic(as_topic(src, key=F.col("k"), value=F.col("v"), topic="t", offset=F.col("o"), headers=hdr), path=path)
    back = read_topic(spark, "t", path=path, stream=False, include_headers=True)
    r = back.select(F.col("headers")[0]["key"].alias("hk"), F.col("headers")[0]["value"].cast("string").alias("hv")).first()
    assert (r.hk, r.hv) == ("trace", "t-1")
    assert "headers" not in read_topic(spark, "t", path=path, stream=False).columns
