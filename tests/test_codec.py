from pyspark.sql import functions as F

from heliolake.operators.codec import Field, decode, encode, good_rows, rejected_rows, merge_field, REJECT

VALUES = [
    (1, '{"k": 5, "timestamp": 1754900000123456789}'),
    (2, '{"k": null, "timestamp": 0}'),
    (3, '{"timestamp": null}'),
    (4, '{"k": 0, "timestamp": "abc"}'),
    (5, 'bad'),
    (6, '[1]'),
    (7, None),
    (8, ''),
    (9, '"203.5"'),
    (10, '{"k": "203.5"}'),
    (11, '{"k": 1} junk'),
]


def _decoded(spark):
    df = spark.createDataFrame(VALUES, "offset long, value string")
    fields = [Field("k_get", "double", key="k"),
              Field("k_default", "double", lookup="default", default=-1.0, key="k"),
              Field("k_falsy", "double", lookup="falsy", default=-1.0, key="k"),
              Field("ts", "long", lookup="default", default=0, key="timestamp")]
    return {r.offset: r for r in decode(df, fields, keep=["offset"]).collect()}


def test_missing_null_zero_are_distinct(spark):
    d = _decoded(spark)
    assert (d[1].k_get, d[1].k_default, d[1].k_falsy) == (5.0, 5.0, 5.0)
    assert (d[2].k_get, d[2].k_default, d[2].k_falsy) == (None, None, -1.0)     # explicit null
    assert (d[3].k_get, d[3].k_default, d[3].k_falsy) == (None, -1.0, -1.0)     # absent
    assert (d[4].k_get, d[4].k_default, d[4].k_falsy) == (0.0, 0.0, -1.0)       # zero
    assert d[10].k_get == 203.5                                                  # quoted number


def test_timestamp_cases(spark):
    d = _decoded(spark)
    assert d[1].ts == 1754900000123456789
    assert d[2].ts == 0 and d[3].ts is None
    assert d[4].ts is None and d[4][REJECT] == "bad_ts"


def test_reject_reasons(spark):
    d = _decoded(spark)
    assert d[5][REJECT] == "not_a_json_object" and d[6][REJECT] == "not_a_json_object"
    assert d[7][REJECT] == "null_value" and d[8][REJECT] == "not_a_json_object"
    assert d[9][REJECT] == "not_a_json_object"
    assert d[5].k_default is None                  # no payload -> no fields, not defaults
    assert d[11][REJECT] == "trailing_content"          # strict end: text after the object rejects


def test_good_and_rejected_split(spark):
    df = spark.createDataFrame(VALUES, "offset long, value string")
    dec = decode(df, [Field("k", "double")], keep=["offset"])
    assert good_rows(dec).count() + rejected_rows(dec).count() == len(VALUES)


def test_struct_and_binary_values(spark):
    df = spark.createDataFrame([(1, {"k": 2.0})], "offset long, value struct<k:double>")
    assert decode(df, [Field("k", "double")]).first().k == 2.0
    b = spark.createDataFrame([(bytearray(b'{"k": 3}'),)], "value binary")
    assert decode(b, [Field("k", "int")]).first().k == 3


def test_encode_null_fields(spark):
    df = spark.createDataFrame([("A", None, 1.5)], "id string, x double, y double")
    dropped = encode(df, "id").first().value
    kept = encode(df, "id", keep_nulls=True).first().value
    assert dropped == '{"id":"A","y":1.5}' and kept == '{"id":"A","x":null,"y":1.5}'


def test_merge_field_right_wins(spark):
    df = spark.createDataFrame([('{"a":1,"source_file":"old","b":[1,2]}',), ('[1]',)], "v string")
    r = df.select(merge_field("v", "source_file", F.lit("new.json"))).collect()
    assert r[0][0] == '{"a":1,"b":[1,2],"source_file":"new.json"}' and r[1][0] is None


def test_a_filter_on_the_reason_repeats_no_parse(spark):
    from heliolake.operators.codec import Field, decode, good_rows
    df = spark.createDataFrame([('{"a": 29.5, "b": "x"}',), ('{"a": "1e1"}',), ('{"a": "+7 "}',), ('{"a": "."}',), ("bad",)], "value string")
    fields = [Field("a", "int_round", lookup="default", default=0, required=True), Field("b", lookup="default", default="", required=True)]
    good = good_rows(decode(df, fields))
    assert sorted(map(tuple, good.collect())) == [(7, ""), (10, ""), (30, "x")]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("jsonObjectKeys") + plan.count("json_object_keys") == 1 and plan.count("RLIKE(value") == 2
