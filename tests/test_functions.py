import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from heliolake.functions import scalars as S
from heliolake.functions.text import panel_id, strip, zfill, data_path, topic_path
from heliolake.functions.timefn import hour_of_day, ns_to_timestamp, iso_utc, event_time, floor_div
from heliolake.functions.presentation import map_values, threshold_colour, STATUS_TEXT, STATUS_STEPS, LEVEL_STEPS


def test_hour_of_day_and_ns(spark):
    ns = 1754900000123456789
    row = spark.createDataFrame([(ns,)], "ns long").select(
        hour_of_day("ns").alias("h"), ns_to_timestamp("ns").cast("timestamp_ntz").alias("t"),
        iso_utc(ns_to_timestamp("ns")).alias("iso")).first()
    assert row.h == pytest.approx(((ns // 10**9) % 86400) / 3600.0)
    assert str(row.t) == "2025-08-11 08:13:20.123456"       # integer path: .123456 (float gives .123457)
    assert row.iso == "2025-08-11T08:13:20.123456Z"


def test_floor_div_negative(spark):
    r = spark.createDataFrame([(-1,), (-1000,), (-1001,), (999,)], "x long").select(floor_div("x", 1000)).collect()
    assert [x[0] for x in r] == [-1, -1, -2, 0]


def test_event_time_fallbacks(spark):
    df = spark.createDataFrame([(None, 1000), (0, 1000), (5_000_000, 1000)], "ns long, ms long")
    out = df.select(event_time("ns", "ms", "broker").cast("timestamp_ntz").alias("b"),
                    event_time("ns", on_missing="epoch").cast("timestamp_ntz").alias("e")).collect()
    assert [str(r.b) for r in out] == ["1970-01-01 00:00:01", "1970-01-01 00:00:01", "1970-01-01 00:00:00.005000"]
    assert [str(r.e) for r in out] == ["1970-01-01 00:00:00", "1970-01-01 00:00:00", "1970-01-01 00:00:00.005000"]


def test_rounding_and_integer_assignment(spark):
    df = spark.createDataFrame([(0.25,), (202.5,), (203.5,), (-202.5,), (0.04,)], "x double")
    r = df.select(S.round1("x"), S.round_int("x"), S.trunc_int("x")).collect()
    assert [x[0] for x in r] == [0.3, 202.5, 203.5, -202.5, 0.0]
    assert [x[1] for x in r] == [0, 203, 204, -203, 0]
    assert [x[2] for x in r] == [0, 202, 203, -202, 0]


def test_status_on_unrounded_power(spark):
    r = spark.createDataFrame([(0.04,), (0.0,), (None,)], "p double").select(
        S.inverter_status("p"), S.round1("p")).collect()
    assert [(x[0], x[1]) for x in r] == [("OK", 0.0), ("STANDBY", 0.0), (None, None)]


def test_safe_divide_and_clamp(spark):
    r = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 1.0), (1.0, -1.0)], "p double, v double").select(
        S.safe_divide("p", "v"), S.clamp("p", 0.0, 5.0)).collect()
    assert [x[0] for x in r] == [0.0, 2.5, None, 0.0]
    assert [x[1] for x in r] == [5.0, 5.0, None, 1.0]


def test_panel_id_never_truncates(spark):
    r = spark.createDataFrame([(1,), (42,), (9999,), (10000,), (123456,), (-5,)], "n long").select(
        panel_id(F.lit("LONDON"), F.col("n"))).collect()
    assert [x[0] for x in r] == ["LONDON-P0001", "LONDON-P0042", "LONDON-P9999", "LONDON-P10000",
                                 "LONDON-P123456", "LONDON-P-005"]


@settings(max_examples=40, deadline=None)
@given(st.integers(min_value=-10**9, max_value=10**12))
def test_zfill_matches_python(spark, n):
    got = spark.createDataFrame([(n,)], "n long").select(zfill("n", 4)).first()[0]
    assert got == str(n).zfill(4)


def test_strip_like_python(spark):
    samples = ["  a b \r", "\t x ", "\x1cy\x1f", "", "   ", "\u0085z "]
    r = spark.createDataFrame([(s,) for s in samples], "s string").select(strip("s")).collect()
    assert [x[0] for x in r] == [s.strip() for s in samples]


def test_paths(spark):
    df = spark.createDataFrame([("PARIS", b"PARIS"), ("", b"\xff\xfe"), (None, None)], "k string, kb binary")
    r = df.select(data_path("http://h", "k"), topic_path("root", "kb")).collect()
    assert [x[0] for x in r] == ["http://h/data/PARIS", "http://h/data/", "http://h/data/"]
    assert [x[1] for x in r] == ["root/PARIS", None, None]


def test_value_mapping_and_thresholds(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (None,), (85.0,)], "v double")
    r = df.select(map_values("v", STATUS_TEXT), threshold_colour("v", STATUS_STEPS),
                  threshold_colour("v", LEVEL_STEPS)).collect()
    assert [x[0] for x in r] == ["Not working", "Good", None, None, None]
    assert [x[1] for x in r] == ["dark-red", "green", "green", None, "green"]
    assert [x[2] for x in r] == ["green", "green", "green", None, "red"]
