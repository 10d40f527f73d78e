"""Folder streams, custom sources and sinks, widening sinks."""

import json
import os
import subprocess
import sys
import time

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from heliolake.sinks import committed, widening
from heliolake.sources import custom, files as FS
from heliolake.streaming import folders
from heliolake.streaming.delivery import Backpressure, DeliveryFailed, DeliveryPolicy, deliver, is_transient


def write(root, name, data):
    os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
    with open(os.path.join(root, name), "w", newline="") as f:
        f.write(data)


LOTS = [{"a b[1].json": '[{"a":1},3,{"a":2}]', "x.csv": 'id,t\r\n1,"two\nlines"\r\n2,\r\n', "n.txt": " hi \n\nho\r\n"},
        {"sub/b%20c.json": '{"a":3}\nbad\n{"a":4}', "sub/y.csv": 't,id\nz,3\n', "sub/m.txt": "one"}, {"c.json": '{"a":\n5}', "w.csv": "id\n4\n", "o.txt": "\n \n"}]


@pytest.mark.parametrize("kind", ["json", "csv", "txt"])
def test_folder_stream_equals_batch_and_reads_no_file_twice(spark, scratch, kind):
    root, got = os.path.join(scratch, "in [x]"), []
    columns = {"id": ("int", 0), "t": ("string", "-")}
    for i, lot in enumerate(LOTS):
        for name, data in lot.items():
            write(root, name, data)
        # each run is a restart; the second takes its files one by one
        folders.read_new(spark, root, kind, lambda rows, _: got.extend(map(tuple, rows.collect())), os.path.join(scratch, "ckpt"), columns=columns, max_files=1 if i == 1 else 1000)
    batch = FS.read_folder(spark, root, kind, columns=columns)
    assert got and sorted(map(str, got)) == sorted(str(tuple(r)) for r in batch.collect())


def test_folder_stream_replays_a_failed_batch(spark, scratch):
    root, got, fail = os.path.join(scratch, "in"), [], [True]
    write(root, "a.json", '[{"a":1},{"a":2}]')

    def sink(rows, batch_id):
        if fail.pop() if fail else False:
            raise ValueError("once")
        got.append((batch_id, rows.count()))
    for _ in range(2):
        try:
            folders.read_new(spark, root, "json", sink, os.path.join(scratch, "ckpt"))
        except Exception as e:  # noqa: BLE001 - the first run fails
            assert "once" in str(e)
    assert got == [(0, 2)]
    with pytest.raises(FS.MissingSource):
        folders.new_files(spark, os.path.join(scratch, "none"), "json")


class Counter(custom.LogSource):
    """Two parts of numbers; the length of each stands in a file."""

    @classmethod
    def name(cls):
        return "counter_for_tests"

    def schema(self):
        return "part string, n long, pid long"

    def ends(self):
        with open(self.options["path"]) as f:
            return json.load(f)

    def records(self, part, start, end):
        yield pa.RecordBatch.from_pydict({"part": [part] * (end - start), "n": list(range(start, end)), "pid": [os.getpid()] * (end - start)})


def test_custom_source_in_batch_and_as_stream(spark, scratch):
    custom.register(spark, Counter)
    path = os.path.join(scratch, "ends.json")

    def ends(**n):
        with open(path, "w") as f:
            json.dump(n, f)

    def run():
        q = (spark.readStream.format("counter_for_tests").option("path", path).option("rows_per_task", 10).load()
             .writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r.part, r.n) for r in spark.read.parquet(f"{scratch}/out").collect())
    ends(a=25)
    df = spark.read.format("counter_for_tests").option("path", path).option("rows_per_task", 10).load()
    assert df.rdd.getNumPartitions() == 3 and sorted(r.n for r in df.collect()) == list(range(25))
    assert run() == [("a", i) for i in range(25)]
    assert run() == [("a", i) for i in range(25)]
    ends(a=31, b=4)
    assert run() == [("a", i) for i in range(31)] + [("b", i) for i in range(4)]
    ends()
    assert spark.read.format("counter_for_tests").option("path", path).load().count() == 0


def test_parquet_log_reads_ranges_over_row_groups(spark, scratch):
    spark.range(1000).repartition(1).write.option("parquet.block.size", 2000).parquet(f"{scratch}/t")
    df = custom.read_log(spark, f"{scratch}/t", rows_per_task=70)
    assert df.rdd.getNumPartitions() == 15 and sorted(r.id for r in df.collect()) == list(range(1000))


def failing(scratch):
    """A column expression that fails one row for as long as a file is there."""
    marker = os.path.join(scratch, "fail")

    @F.udf("long")
    def check(i):
        if i == 37 and os.path.exists(marker):
            raise RuntimeError("killed in mid-batch")
        return i
    return marker, check


def test_a_task_that_fails_leaves_nothing_visible(spark, scratch):
    marker, check = failing(scratch)
    out, src = f"{scratch}/out", f"{scratch}/in"
    schema = StructType([StructField("id", LongType())])
    for lot in (range(0, 20), range(20, 60)):
        spark.createDataFrame([(i,) for i in lot], schema).repartition(3).write.mode("append").parquet(src)
        if 37 in lot:
            open(marker, "w").close()

        def run():
            stream = spark.readStream.schema(schema).parquet(src).select(check("id").alias("id"))
            committed.start_committed(stream, out, f"{scratch}/ckpt", available_now=True).awaitTermination()

        def seen():
            return sorted(r.id for r in committed.read_committed(spark, out, schema).collect())
        if 37 in lot:
            with pytest.raises(Exception, match="mid-batch"):
                run()
            assert seen() == list(range(20))
            os.remove(marker)
        run()
        run()
        assert seen() == list(range(lot.stop))
    assert sorted(d for d in os.listdir(out) if d.startswith("_batch")) == ["_batch=0", "_batch=1"]


def test_a_committed_batch_is_not_committed_again(scratch):
    schema = StructType([StructField("id", LongType())])
    writer = committed._StreamWriter(scratch, schema)
    stage = lambda *ids: writer.write(iter([pa.RecordBatch.from_pydict({"id": list(ids)})]))
    writer.commit([stage(1), stage(2, 3), writer.write(iter([]))], 0)
    writer.commit([stage(1), stage(2, 3)], 0)            # the replay
    taken_back = stage(9)
    writer.abort([taken_back, None], 1)
    found = [f for d, _, files in os.walk(scratch) for f in files]
    assert len(found) == 2 and taken_back.rows == 1


def test_batch_write_is_visible_at_once(spark, scratch):
    marker, check = failing(scratch)
    schema = StructType([StructField("id", LongType())])
    df = spark.createDataFrame([(i,) for i in range(50)], schema).repartition(4).select(check("id").alias("id"))
    open(marker, "w").close()
    with pytest.raises(Exception, match="mid-batch"):
        committed.write_committed(df, f"{scratch}/t")
    assert committed.read_committed(spark, f"{scratch}/t", schema).count() == 0
    os.remove(marker)
    committed.write_committed(df, f"{scratch}/t")
    assert committed.read_committed(spark, f"{scratch}/t", schema).count() == 50


@pytest.mark.parametrize("a, b, want", [
    (IntegerType(), LongType(), LongType()), (LongType(), DoubleType(), DoubleType()), (IntegerType(), IntegerType(), IntegerType()), (LongType(), StringType(), StringType()),
    (BooleanType(), LongType(), StringType()), (DecimalType(10, 2), DecimalType(12, 5), DecimalType(13, 5)), (DateType(), TimestampNTZType(), TimestampNTZType())])
def test_wider_types(a, b, want):
    assert widening.wider(a, b) == want and widening.wider(b, a) == want


def test_widening_table(spark, scratch):
    table = widening.WideningTable(spark, f"{scratch}/t")
    assert table.read().count() == 0

    def rows(*values):
        return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset long")
    first = rows('{"a":1,"b":"x"}', "bad", '{"a":null}', "[1]")
    second = rows('{"a":2.5,"C":{"k":[1,null]},"b":7}', '{"c":true,"a":9007199254740993}')
    assert table.append_json(first, 0, keep=["offset"]) == 1
    assert table.append_json(rows('{"a":3}'), 1, keep=["offset"]) == 1
    assert table.append_json(second, 2, keep=["offset"]) == 2
    assert table.append_json(first, 0, keep=["offset"]) == 2          # replayed after the columns have grown
    assert table.schema().simpleString() == "struct<offset:bigint,a:double,b:string,C:string,c_1:boolean>"
    got = sorted((tuple(r) for r in table.read().collect()), key=str)
    assert got == sorted([(0, 1.0, "x", None, None), (1, None, None, None, None), (2, None, None, None, None), (3, None, None, None, None), (0, 3.0, None, None, None),
                          (0, 2.5, "7", '{"k":[1,null]}', None), (1, 9007199254740992.0, None, None, True)], key=str)
    with pytest.raises(Exception, match="exist"):
        table._commit(2, table.schema())                               # another writer's number


def test_widening_reads_old_integers_as_long_and_double(spark, scratch):
    table = widening.WideningTable(spark, f"{scratch}/t")
    for i, kind in enumerate(("int", "long", "double")):
        table.append(spark.range(3).selectExpr(f"cast(id as {kind}) as x", *([f"id as new{i}"] if i else [])), i)
    assert table.schema().simpleString() == "struct<x:double,new1:bigint,new2:bigint>"
    assert sorted(r.x for r in table.read().collect()) == [0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0]
    assert table.read().where("new1 is null").count() == 6


cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers do not see this file


class Endpoint:
    """Keeps what it gets, one file a call; refuses, or dies after some calls, as files in its folder say."""

    def __init__(self, path):
        self.path, self.calls = path, 0

    def __call__(self, rows):
        state = {}
        if os.path.exists(f"{self.path}/state"):
            with open(f"{self.path}/state") as f:
                state = json.load(f)
        if rows[0][0] in state.get("refuse", []):
            raise Backpressure(0.0)
        if rows[0][0] == 1 and self.calls >= state.get("die_after", 10 ** 9):
            raise KeyError("the worker dies")
        self.calls += 1
        with open(f"{self.path}/{time.time_ns():020d}.got", "w") as f:
            json.dump(rows, f)

    def got(self):
        rows = {}
        for name in sorted(n for n in os.listdir(self.path) if n.endswith(".got")):
            with open(f"{self.path}/{name}") as f:
                for p, o in json.load(f):
                    rows.setdefault(p, []).append(o)
        return rows

    def set(self, **state):
        with open(f"{self.path}/state", "w") as f:
            json.dump(state, f)


def test_ledger_resends_only_what_was_not_delivered(spark, scratch):
    from heliolake.streaming.ledger import DeliveryLedger
    end = Endpoint(scratch)
    path = scratch
    ledger = DeliveryLedger(spark, f"{scratch}/ledger", lambda: Endpoint(path), ["partition", "offset"], chunk_size=10, policy=DeliveryPolicy(backpressure_wait_s=0.0, max_backpressure_waits=1))
    batch = spark.createDataFrame([(p, o) for p in (0, 1, 2) for o in range(75)], "partition int, offset long").repartition(4)
    end.set(die_after=3)
    with pytest.raises(Exception, match="the worker dies"):
        ledger.deliver(batch, 0)
    before = end.got()
    assert before[1] == list(range(30))
    end.set()
    ledger.deliver(batch, 0)             # Spark replays the batch
    ledger.deliver(batch, 0)             # and once more, after it was finished
    assert end.got() == {p: list(range(75)) for p in (0, 1, 2)}
    assert all(len(os.listdir(f"{scratch}/ledger/delivered/{p}")) <= 2 for p in (0, 1, 2))


def test_a_partition_that_refuses_is_parked_and_follows_in_order(spark, scratch):
    from heliolake.streaming.ledger import DeliveryLedger
    end, path = Endpoint(scratch), scratch
    ledger = DeliveryLedger(spark, f"{scratch}/ledger", lambda: Endpoint(path), ["partition", "offset"], chunk_size=4, policy=DeliveryPolicy(backpressure_wait_s=0.0, max_backpressure_waits=1))

    def batch(i):
        return spark.createDataFrame([(p, o) for p in range(8) for o in range(10 * i, 10 * i + 10)], "partition int, offset long").repartition(3)
    schema = StructType([StructField("partition", IntegerType()), StructField("offset", LongType())])
    end.set(refuse=[5])
    ledger.deliver(batch(0), 0)
    ledger.deliver(batch(1), 1)
    assert end.got() == {p: list(range(20)) for p in range(8) if p != 5}
    assert [tuple(r) for r in ledger.parked(schema).collect()] == [(5, 0, 20)]
    end.set()
    ledger.deliver(batch(2), 2)
    assert end.got() == {p: list(range(30)) for p in range(8)}
    assert ledger.parked(schema).count() == 0


def test_rate_is_a_word():
    assert is_transient(RuntimeError("Rate limit reached")) and is_transient(RuntimeError("write quotas")) and is_transient(RuntimeError("rate-limited"))
    assert not any(is_transient(RuntimeError(m)) for m in ("cannot operate", "generated column", "separate table", "accurate"))
    with pytest.raises(DeliveryFailed):
        deliver(lambda: (_ for _ in ()).throw(Backpressure(1.0)), DeliveryPolicy(), sleep=lambda s: None)


def test_entry_by_path_from_another_folder(scratch):
    """Python workers get the package from the session, not from a path."""
    code = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", entry.queries()["json_files_source"](spark, "/root/testdata/sf0.001").count(), entry.queries()["custom_source"](spark, "/root/testdata/sf0.001").count())
"""
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    out = subprocess.run([sys.executable, "-c", code, entry], cwd=scratch, capture_output=True, text=True, timeout=300, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0 and "rows " in out.stdout, out.stderr[-2000:]
