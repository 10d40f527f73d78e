"""Skewed keys (one key = a third of all rows) against a pandas brute force; text lines against
Python's split/strip on random Unicode text."""

import datetime as dt

import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from heliolake.operators.latest import key_age_seconds, latest_per_key
from heliolake.operators.windows import aggregate_window
from heliolake.sources.files import text_lines


def _skewed(n=30_000):
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{i % 997}"
        rows.append((key, i, base + dt.timedelta(seconds=(i * 7919) % 86_400), float(i % 101)))
    return pd.DataFrame(rows, columns=["k", "off", "t", "v"])


def test_skewed_latest_and_age_match_brute_force(spark):
    pdf = _skewed()
    df = spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz")).repartition(16)
    got = {r.k: (r.off, r.v) for r in latest_per_key(df, ["k"], ["off"]).collect()}
    want = pdf.loc[pdf.groupby("k")["off"].idxmax()].set_index("k")
    assert got == {k: (int(r.off), float(r.v)) for k, r in want.iterrows()}

    ages = key_age_seconds(df, "k", "t").groupBy("k").agg(F.max("age_s").alias("a")).collect()
    span = (pdf.groupby("k")["t"].max() - pdf.groupby("k")["t"].min()).dt.total_seconds().astype(int)
    assert {r.k: r.a for r in ages} == span.to_dict()


def test_skewed_window_last_matches_brute_force(spark):
    pdf = _skewed()
    df = (spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz"))
          .select("k", F.col("t").alias("_time"), "off", F.col("v").alias("_value")).repartition(16))
    got = {(r.k, r._time): r._value for r in aggregate_window(df, "1 hour", "last", series=["k"], order_col="off").collect()}
    pdf["end"] = pdf["t"].dt.floor("h") + pd.Timedelta(hours=1)
    last = pdf.sort_values(["t", "off"]).groupby(["k", "end"]).tail(1)
    assert got == {(r.k, r.end.to_pydatetime()): r.v for r in last.itertuples()}


WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        　 "
TEXT = st.text(alphabet=st.sampled_from(list(WS) + list("abcé語​")), max_size=60)


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_text_lines_match_python(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source_file string, content string")
    got = sorted((r.source_file, r.line_no, r.content) for r in text_lines(df).collect())
    want = sorted((str(i), n + 1, line.strip()) for i, t in enumerate(texts)
                  for n, line in enumerate(t.split("\n")) if line.strip())
    assert got == want
