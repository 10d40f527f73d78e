import random

import pytest
from pyspark.sql import functions as F

from heliolake.operators.latest import key_age_seconds
from heliolake.streaming.first_seen import KeyAges
from heliolake.streaming.jobs import run_to_end
from heliolake.streaming.row_batches import RowBatches


def test_row_batches_are_bounded_numbered_and_sent_once(spark, scratch):
    src, seen, lost = scratch + "/in", [], []

    def sink(rows, number):
        if number == 3 and not lost:
            lost.append(number)
            raise RuntimeError("sink lost")
        seen.append((number, [r.id for r in rows.select("id").collect()]))

    def run():
        run_to_end(spark.readStream.schema("id long").parquet(src), RowBatches(sink, scratch + "/own", 100), scratch + "/ckpt")

    spark.range(0, 1000, 1, 1).write.parquet(src)                   # one file far beyond the cap
    with pytest.raises(Exception, match="sink lost"):
        run()
    assert [n for n, _ in seen] == [0, 1, 2]
    run()                                                            # the rest of the same micro-batch
    spark.range(1000, 1130, 1, 4).write.mode("append").parquet(src)  # small files share a batch
    run()
    assert [n for n, _ in seen] == list(range(len(seen)))
    assert sorted(i for _, ids in seen for i in ids) == list(range(1130))
    assert all(0 < len(ids) <= 100 for _, ids in seen) and len(seen) == 12
    assert [sorted(ids) for _, ids in seen[:10]] == [list(range(100 * i, 100 * i + 100)) for i in range(10)]
    seen.clear()
    RowBatches(sink, scratch + "/other", 100)(spark.range(0), 0)
    assert not seen
    with pytest.raises(ValueError):
        RowBatches(sink, scratch, 0)


def test_key_ages_equal_the_batch_answer_in_any_order(spark, scratch):
    rnd = random.Random(5)
    rows = [(None if k == 3 else f"p{k}", i, rnd.randrange(10_000_000)) for i, k in enumerate(rnd.choices(range(6), [1, 1, 1, 1, 1, 10], k=300))]
    rows.append(("never", 300, None))
    df = spark.createDataFrame(rows, "k string, i long, s long").select("k", "i", F.timestamp_seconds("s").alias("t"))
    df = df.orderBy(F.col("t").desc()).coalesce(1)
    ages = KeyAges(scratch + "/firsts")
    for part in (F.col("t") >= F.timestamp_seconds(F.lit(6_000_000)), (F.col("t") < F.timestamp_seconds(F.lit(6_000_000))) | F.col("t").isNull()):
        df.filter(part).write.mode("append").parquet(scratch + "/in")          # later readings first, then a restart
        ages.run_to_end(spark.readStream.schema(df.schema).parquet(scratch + "/in"), "k", "t", scratch + "/ckpt", salts=2)
    got = {r.i: r.age_s for r in ages.ages(df, "k", "t").collect()}
    assert got == {r.i: r.age_s for r in key_age_seconds(df, "k", "t").collect()} and len(got) == 301


def test_idle_states_are_freed(spark, scratch):
    import time
    spark.createDataFrame([("p", 50)], "k string, s long").select("k", F.timestamp_seconds("s").alias("t")).write.parquet(scratch + "/in")
    stream = spark.readStream.schema("k string, t timestamp").parquet(scratch + "/in")
    ages, batches = KeyAges(scratch + "/firsts"), []
    keep = ages._keep
    ages._keep = lambda rows, i: (batches.extend(r.second for r in rows.collect()), keep(rows, i))
    q = ages.start(stream, "k", "t", scratch + "/ckpt", idle_ms=1, salts=1)
    try:
        for second in (50, 90):                    # 90 is not below 50: only a freed state tells it
            until = time.time() + 60
            while second not in batches and time.time() < until:
                time.sleep(0.3)
            if second == 50:
                spark.createDataFrame([("p", 90)], "k string, s long").select("k", F.timestamp_seconds("s").alias("t")).write.mode("append").parquet(scratch + "/in")
    finally:
        q.stop()
    assert set(batches) == {50, 90} and [r.second for r in ages.firsts().collect()] == [50]


def test_several_batches_are_out_at_once_and_none_is_lost(spark, scratch):
    import threading
    src, both, lost, seen = scratch + "/in", threading.Barrier(2, timeout=60), [], []

    def sink(rows, number):
        if number < 2 and not lost:
            both.wait()                            # passes only if batches 0 and 1 are with the sink together
        if number == 1 and not lost:
            lost.append(number)
            raise RuntimeError("sink lost")
        seen.append((number, rows.count()))

    def run():
        run_to_end(spark.readStream.schema("id long").parquet(src), RowBatches(sink, scratch + "/own", 100, at_once=2), scratch + "/ckpt")

    spark.range(0, 1050, 1, 1).write.parquet(src)
    with pytest.raises(Exception, match="sink lost"):
        run()
    assert 1 not in [n for n, _ in seen]
    run()
    assert sorted(n for n, _ in seen) == list(range(11)) and sum(k for _, k in seen) == 1050 and max(k for _, k in seen) == 100


def test_states_that_are_kept_need_no_python(spark, scratch):
    from heliolake.streaming.first_seen import first_seconds
    spark.range(1).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("t")).write.parquet(scratch + "/in")
    stream = spark.readStream.schema("k string, t timestamp").parquet(scratch + "/in")
    plan = first_seconds(stream, "k", "t")._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan
