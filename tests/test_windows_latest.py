import pytest
from pyspark.sql import functions as F

from heliolake.operators.latest import key_age_seconds, latest_per_key
from heliolake.operators.lookup import lookup, rejects, validate_keys
from heliolake.operators.windows import aggregate_window, last_not_null, time_range, yield_all, to_series
from heliolake.sinks.table import KeyedTable

ROWS = [
    # series, time, offset, value
    ("a", "2024-01-01 00:00:00", 1, 1.0),    # exactly at range start (kept)
    ("a", "2024-01-01 00:59:59", 2, 2.0),
    ("a", "2024-01-01 01:00:00", 3, 3.0),    # exactly at a window edge -> next window
    ("a", "2024-01-01 01:30:00", 5, 5.0),    # tie on time: higher offset wins
    ("a", "2024-01-01 01:30:00", 4, 4.0),
    ("a", "2024-01-01 02:10:00", 6, None),   # all-null window -> omitted
    ("a", "2024-01-01 03:00:00", 7, 7.0),    # exactly at range stop (excluded)
    ("b", "2024-01-01 00:10:00", 8, 10.0),
]


@pytest.fixture()
def readings(spark):
    return spark.createDataFrame(ROWS, "s string, t string, o long, v double").select(
        "s", F.col("t").cast("timestamp_ntz").alias("_time"), "o", F.col("v").alias("_value"))


def test_window_last_bounds_ties_and_empty(readings):
    out = aggregate_window(readings, "1 hour", "last", series=["s"], order_col="o",
                           start="2024-01-01 00:00:00", stop="2024-01-01 03:00:00")
    got = sorted((r.s, str(r._time), r._value) for r in out.collect())
    assert got == [("a", "2024-01-01 01:00:00", 2.0), ("a", "2024-01-01 02:00:00", 5.0),
                   ("b", "2024-01-01 01:00:00", 10.0)]


def test_window_stop_clipped(readings):
    out = aggregate_window(readings, "1 hour", "mean", series=["s"], start="2024-01-01 00:00:00",
                           stop="2024-01-01 01:15:00")
    got = sorted((r.s, str(r._time), r._value) for r in out.collect())
    assert got == [("a", "2024-01-01 01:00:00", 1.5), ("a", "2024-01-01 01:15:00", 3.0),
                   ("b", "2024-01-01 01:00:00", 10.0)]


def test_last_not_null_and_yield(readings):
    lnn = {r.s: r._value for r in last_not_null(readings, series=["s"], order_col="o").collect()}
    assert lnn == {"a": 7.0, "b": 10.0}
    y = yield_all({"x": readings.limit(1), "y": readings.limit(2)})
    assert sorted(r.result for r in y.collect()) == ["x", "y", "y"]
    assert time_range(readings, "2024-01-01 01:00:00", "2024-01-01 02:00:00").count() == 3


def test_to_series_long_form(spark):
    df = spark.createDataFrame([("p1", "2024-01-01 00:00:00", 1.0, 2.0)], "panel string, t string, a double, b double")
    out = to_series(df.withColumn("t", F.col("t").cast("timestamp")), "t", "solar", ["a", "b"], tags=["panel"])
    assert sorted((r._field, r._value) for r in out.collect()) == [("a", 1.0), ("b", 2.0)]


def test_latest_per_key_and_key_age(spark):
    df = spark.createDataFrame([("p", 1, 10.0, "2024-01-01 00:00:00"), ("p", 3, 30.0, "2024-01-01 00:00:05"),
                                ("p", 2, 20.0, "2024-01-01 00:00:09"), ("q", 4, 40.0, "2024-01-01 00:00:01")],
                               "k string, off long, v double, t string").withColumn("t", F.col("t").cast("timestamp"))
    latest = {r.k: (r.off, r.v) for r in latest_per_key(df, ["k"], ["off"]).collect()}
    assert latest == {"p": (3, 30.0), "q": (4, 40.0)}
    ages = sorted((r.k, r.age_s) for r in key_age_seconds(df, "k", "t").collect())
    assert ages == [("p", 0), ("p", 5), ("p", 9), ("q", 0)]


def test_keyed_table_upsert_replay(spark, scratch):
    t = KeyedTable(scratch + "/kt", keys=["id"], order=["off"], buckets=4)
    b0 = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 3, "c")], "id int, off long, v string")
    b1 = spark.createDataFrame([(1, 4, "d"), (3, 5, "e"), (None, 6, "null-key")], "id int, off long, v string")
    t.upsert(b0, 0)
    t.upsert(b1, 1)
    before = sorted(tuple(r) for r in t.read().collect())
    t.upsert(b1, 1)                          # replay of the same batch id: no change
    after = sorted(tuple(r) for r in t.read().collect())
    assert before == after == [(1, 4, "d"), (2, 3, "c"), (3, 5, "e")]
    assert [(r.v, r._reason) for r in t.rejects().collect()] == [("null-key", "null_key")]
    t.compact()
    t.upsert(b0, 0)                          # replay of a merged batch: no change
    assert sorted(tuple(r) for r in t.read().collect()) == after


def test_keyed_table_reads_a_bounded_number_of_generations(spark, scratch):
    t = KeyedTable(scratch + "/many", keys=["id"], order=["off"], buckets=4, compact_every=4)
    want = {}
    for i in range(13):
        rows = [(k, i, f"{i}-{k}") for k in range(i, i + 5)]
        want |= {k: (k, o, v) for k, o, v in rows}
        t.upsert(spark.createDataFrame(rows, "id int, off long, v string"), i)
        assert t.generations() <= 4 + 4
    assert sorted(tuple(r) for r in t.read().collect()) == sorted(want.values())


def test_keyed_table_splits_buckets_and_removes_generations(spark, scratch):
    import glob
    import hashlib
    import os
    path, want, files = scratch + "/grows", {}, []
    t = KeyedTable(path, keys=["id"], order=["off"], buckets=3, compact_every=2, bucket_bytes=12000, keep_commits=3)
    for i in range(8):
        rows = [(k, i, hashlib.sha512(f"{i}-{k}".encode()).hexdigest()) for k in range(i * 100, i * 100 + 200)]
        want |= {k: (k, o, v) for k, o, v in rows}
        t.upsert(spark.createDataFrame(rows, "id int, off long, v string"), i)
        files.append(len(glob.glob(path + "/_gen=*")))
    assert sorted(tuple(r) for r in t.read().collect()) == sorted(want.values())
    assert t.bucket_count() > 6
    t.compact()
    # every bucket is read from one place, and holds its own keys only
    state = t._pointers().newest()
    assert sorted(map(int, state["base"])) == list(range(t.bucket_count()))
    base = t._rows(t._base(state))
    assert base.filter(F.col("_bucket") != t._bucket(["id"], *state["buckets"])).count() == 0
    assert base.count() == base.select("id").distinct().count() == len(want)
    assert max(files) <= 3 + 4 and len(os.listdir(path + "/_commits")) < 4 * 4
    before = t.bucket_count()
    t.upsert(spark.createDataFrame([(1, 99, "x")], "id int, off long, v string"), 8)       # one bucket touched: the others keep their files
    t.compact()
    after = t._pointers().newest()
    assert t.bucket_count() == before and sum(after["base"][b] != state["base"][b] for b in state["base"]) == 1


def test_keyed_table_of_two_writers(spark, scratch):
    t = KeyedTable(scratch + "/two", keys=["id"], order=["off"])
    row = lambda *r: spark.createDataFrame([r], "id int, off long, v string")
    t.upsert(row(1, 1, "a"), 0)
    ours, theirs = t._pointers(), t._pointers()
    mine, other = ours.newest(), theirs.newest()
    theirs.commit(other)
    with pytest.raises(RuntimeError, match="another writer"):
        ours.commit(mine)
    assert [tuple(r) for r in t.read().collect()] == [(1, 1, "a")]


def test_keyed_table_without_rows(spark, scratch):
    t = KeyedTable(scratch + "/none", keys=["id"], order=["off"], compact_every=2)
    none = spark.createDataFrame([], "id int, off long, v string")
    for i in range(3):
        t.upsert(none, i)
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(spark.createDataFrame([(1, 1, "a")], none.schema), 3)
    assert [tuple(r) for r in t.read().collect()] == [(1, 1, "a")]


@pytest.mark.parametrize("fn", ["mean", "last"])
def test_window_table_takes_rows_in_any_order(spark, scratch, fn):
    from heliolake.sinks.table import WindowTable
    rows = [("p", i, float(i % 7), f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, off long, v double, t string").withColumn("t", F.col("t").cast("timestamp"))
    t = WindowTable(scratch + "/" + fn, "1 hour", fn, time_col="t", value_col="v", series=["k"], lateness_s=600, order_col="off", compact_every=2)
    for i in range(4, -1, -1):               # the newest hour comes first
        t.upsert(df.filter((F.col("off") >= 60 * i) & (F.col("off") < 60 * i + 60)), 4 - i)
    want = aggregate_window(df, "1 hour", fn, time_col="t", value_col="v", series=["k"], order_col="off")
    assert sorted(tuple(r) for r in t.read().collect()) == sorted(tuple(r) for r in want.collect())
    assert t.late().count() > 0 and {r[0] for r in t.late().select("_reason").distinct().collect()} == {"window_closed"}


def test_lookup_case_insensitive_and_rejects(spark):
    dim = spark.createDataFrame([("LONDON", 1), ("PARIS", 2), ("paris", 3)], "location_id string, tz int")
    probe = spark.createDataFrame([("london",), ("Paris",), ("Oslo",)], "loc string")
    got = sorted((r.loc, r.tz) for r in lookup(probe, dim, "loc", "location_id").collect())
    assert got == [("Paris", 2), ("london", 1)]        # duplicate key: first by key text wins
    assert [r.loc for r in rejects(probe, dim, "loc", "location_id").collect()] == ["Oslo"]
    with pytest.raises(ValueError, match="Oslo"):
        validate_keys(probe, dim, "loc", "location_id")
    many = spark.range(50).select(F.concat(F.lit("x"), F.col("id")).alias("loc"))
    import os, tempfile
    path = os.path.join(tempfile.mkdtemp(), "report")
    with pytest.raises(ValueError, match="50 invalid loc"):
        validate_keys(many, dim, "loc", "location_id", report_path=path)
    report = spark.read.parquet(path)
    assert report.filter("kind = 'invalid'").count() == 50 and report.filter("kind = 'valid'").count() == 3


def test_relative_range_last_15_minutes(spark):
    from heliolake.operators.windows import relative_range
    df = spark.createDataFrame([("2024-01-01 09:44:59",), ("2024-01-01 09:45:00",), ("2024-01-01 09:59:59",),
                                ("2024-01-01 10:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    start, stop = relative_range(15, now="2024-01-01 10:00:00")
    kept = [str(r.t) for r in time_range(df, start, stop, "t").collect()]
    assert kept == ["2024-01-01 09:45:00", "2024-01-01 09:59:59"]
