import json
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from heliolake.sinks.lines import line_protocol
from heliolake.sinks.table import create_table_ddl, upsert_statement, write_jdbc_partitions, append_table
from heliolake.sinks.transport import http_requests, mqtt_messages, post_records, BatchSink
from heliolake.streaming.delivery import (Backpressure, BatchLedger, DeliveryFailed, DeliveryPolicy, deliver,
                                          is_transient, send_partitions)
from heliolake.operators.layouts import READING_FIELDS


class Flaky:
    def __init__(self, failures, exc):
        self.failures, self.exc, self.calls = failures, exc, 0

    def __call__(self):
        self.calls += 1
        if self.calls <= self.failures:
            raise self.exc



def test_retry_then_success():
    waits = []
    f = Flaky(2, ConnectionError("down"))
    assert deliver(f, DeliveryPolicy(), sleep=waits.append) == 3
    assert waits == [3.0, 3.0]


def test_retry_exhausted():
    f = Flaky(3, ConnectionError("down"))
    with pytest.raises(DeliveryFailed):
        deliver(f, DeliveryPolicy(), sleep=lambda s: None)
    assert f.calls == 3


def test_backpressure_and_rate_text():
    waits = []
    f = Flaky(1, Backpressure(30.0))
    deliver(f, DeliveryPolicy(), sleep=waits.append)
    assert waits == [30.0]
    g = Flaky(1, RuntimeError("Quota exceeded for writes"))
    waits.clear()
    deliver(g, DeliveryPolicy(backpressure_wait_s=60.0), sleep=waits.append)
    assert waits == [60.0] and is_transient(RuntimeError("rate limited")) and not is_transient(ValueError("x"))
    with pytest.raises(ValueError):
        deliver(Flaky(1, ValueError("schema")), DeliveryPolicy(), sleep=lambda s: None)


def test_send_partitions_http_shape(spark, scratch):
    out = os.path.join(scratch, "sent.jsonl")
    df = spark.createDataFrame([("PARIS", 1.0), ("", 2.0), (None, 3.0)], "location_id string, v double")
    def to_file(records):                    # a local function travels to the workers by value
        with open(out, "a", encoding="utf-8") as f:
            f.writelines(json.dumps(list(r)) + "\n" for r in records)

    post_records(df, "http://api", make_sender=lambda: to_file, chunk_size=2)
    sent = sorted(json.loads(l)[0] for l in open(out))
    assert sent == ["http://api/data/", "http://api/data/", "http://api/data/PARIS"]
    req = http_requests(df, "http://api").collect()
    assert json.loads(req[0].body) == {"location_id": "PARIS", "v": 1.0}


def test_mqtt_shape_rejects_bad_keys(spark):
    env = spark.createDataFrame([(b"PARIS", "{}"), (None, "{}"), (b"\xff", "{}")], "key binary, value string")
    rows = sorted((r.topic or "", r._reject or "") for r in mqtt_messages(env, "solar").collect())
    assert rows == [("", "bad_key"), ("", "bad_key"), ("solar/PARIS", "")]


def test_ledger(spark, scratch):
    led = BatchLedger(spark, os.path.join(scratch, "ledger"))
    assert not led.done(3)
    led.mark(3)
    assert led.done(3)


def test_line_protocol_escaping(spark):
    df = spark.createDataFrame([("a b,c=d", 'say "hi"\\', 1.5, 7, None), ("x", None, None, None, 1)],
                               "tag string, s string, f double, i long, t long")
    r = df.select(line_protocol(df, "my meas", ["tag"], ["s", "f", "i"], "t")).collect()
    assert r[0][0] == 'my\\ meas,tag=a\\ b\\,c\\=d s="say \\"hi\\"\\\\",f=1.5,i=7i'
    assert r[1][0] is None                                   # no field -> no line


def test_jdbc_upsert_sqlite(spark, scratch):
    from pyspark.sql.types import StructType, StructField, StringType, LongType, DoubleType
    db = os.path.join(scratch, "t.db")
    schema = StructType([StructField("panel_id", StringType()), StructField("ts", LongType()),
                         StructField("power", DoubleType())])
    ddl = create_table_ddl("readings", schema, ["panel_id", "ts"]).replace("DOUBLE PRECISION", "REAL")
    con = sqlite3.connect(db)
    con.execute(ddl)
    con.commit()
    con.close()
    stmt = upsert_statement("readings", ["panel_id", "ts", "power"], ["panel_id", "ts"])
    b1 = spark.createDataFrame([("P1", 1, 1.0), ("P2", 1, 2.0)], schema)
    b2 = spark.createDataFrame([("P1", 1, 9.0), ("P3", 2, 3.0)], schema)
    for b in (b1, b2, b2):
        write_jdbc_partitions(b, lambda: sqlite3.connect(db, timeout=30), stmt, ["panel_id", "ts", "power"])
    con = sqlite3.connect(db)
    rows = sorted(con.execute("select * from readings").fetchall())
    assert rows == [("P1", 1, 9.0), ("P2", 1, 2.0), ("P3", 2, 3.0)]


def test_ddl_text():
    from pyspark.sql.types import StructType, StructField, StringType, IntegerType
    ddl = create_table_ddl("t", StructType([StructField("a", StringType()), StructField("b", IntegerType())]), ["a"])
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS t") and "PRIMARY KEY (a)" in ddl and "b INTEGER" in ddl
    assert len(READING_FIELDS) == 18


def test_append_table_layout(spark, scratch):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")], "id int, t string") \
        .withColumn("t", F.col("t").cast("timestamp"))
    append_table(df, scratch + "/daily", time_col="t", sort_by=["id"])
    names = sorted(n for n in os.listdir(scratch + "/daily") if n.startswith("event_date="))
    assert names == ["event_date=2024-01-01", "event_date=2024-01-02"]


def test_batch_sink_template(spark):
    seen = []

    class Collect(BatchSink):
        def setup(self):
            seen.append("setup")

        def write(self, batch, batch_id):
            seen.append((batch_id, batch.count()))

    fn = Collect().as_batch_fn()
    fn(spark.range(3), 0)
    fn(spark.range(2), 1)
    assert seen == ["setup", (0, 3), (1, 2)]
