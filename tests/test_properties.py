"""Property tests: decode lookup rules and day-curve / clamp functions against plain Python."""

import json
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from heliolake.functions import scalars as S
from heliolake.operators.codec import Field, decode

VALUE = st.one_of(st.none(), st.integers(-1000, 1000), st.floats(-1e6, 1e6, allow_nan=False),
                  st.sampled_from(["", "x", "203.5"]))
PAYLOAD = st.dictionaries(st.sampled_from(["k", "a", "b"]), VALUE, max_size=3)


def _num(v):
    """What a typed double column holds for a JSON value (strings that are numbers convert)."""
    if v is None:
        return None
    if isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        return float(v)
    try:
        return float(v)
    except ValueError:
        return None


@settings(max_examples=25, deadline=None)
@given(st.lists(PAYLOAD, min_size=1, max_size=20))
def test_lookup_rules_match_python(spark, payloads):
    rows = [(i, json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "offset long, value string")
    fields = [Field("g", "double", key="k"),
              Field("d", "double", lookup="default", default=-1.0, key="k"),
              Field("f", "double", lookup="falsy", default=-1.0, key="k")]
    got = {r.offset: r for r in decode(df, fields, keep=["offset"]).collect()}
    for i, p in enumerate(payloads):
        r = got[i]
        assert r.g == _num(p.get("k"))                                   # d.get(k)
        assert r.d == (_num(p["k"]) if "k" in p else -1.0)                # d.get(k, default)
        v = _num(p.get("k"))
        raw = p.get("k")
        assert r.f == (-1.0 if (not raw or v is None or v == 0) else v)   # d.get(k) or default
        bad = "k" in p and raw is not None and _num(raw) is None
        assert (r._reject == "bad_g") == bad


@settings(max_examples=40, deadline=None)
@given(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False)), st.floats(-10, 0), st.floats(0, 10))
def test_clamp_matches_python(spark, x, lo, hi):
    got = spark.createDataFrame([(x,)], "x double").select(S.clamp(F.col("x"), lo, hi)).first()[0]
    assert got == (None if x is None else max(lo, min(hi, x)))
