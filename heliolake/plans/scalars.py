"""Scalar-function queries: identifiers, paths, rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from heliolake.functions import scalars as S
from heliolake.functions.text import data_path, panel_id, topic_path
from heliolake.plans.registry import register
from heliolake.sinks.transport import http_requests, mqtt_messages
from heliolake.sources.topic import as_topic
from heliolake.streaming.jobs import tap
from heliolake.streaming.delivery import Backpressure, DeliveryPolicy, deliveries
from heliolake.tables import table

@register("panel_code", "F21 F20", oracle="""
SELECT c_custkey, upper(c_mktsegment) || '-P' || lpad(CAST(c_custkey AS VARCHAR),
       greatest(4, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS panel_id
FROM customer
""")
def panel_code(spark: SparkSession, root: str) -> DataFrame:
    """Zero-padded panel ids (4 digits minimum, longer numbers kept whole)."""
    c = table(spark, root, "customer")
    return c.select("c_custkey", panel_id(F.upper("c_mktsegment"), F.col("c_custkey")).alias("panel_id"))


_ROUTE_LOC = """CASE CAST(json_extract(props, '$.k') AS INTEGER) % 10 WHEN 6 THEN ''
                    WHEN 7 THEN NULL ELSE upper(event_type) END"""


class _Unsteady:
    """An endpoint that fails by the record's id, a fixed number of times."""

    def __init__(self):
        self.calls: dict[int, int] = {}

    def __call__(self, records: list) -> None:
        for (i,) in records:
            n = self.calls[i] = self.calls.get(i, 0) + 1
            lost, busy, quota = 2 * (i % 5 == 0), 3 * (i % 7 == 0), i % 11 == 0
            if n <= lost:
                raise ConnectionError("connection lost")
            if n <= lost + busy:
                raise Backpressure(0.0)
            if n <= lost + busy + quota:
                raise RuntimeError("Quota exceeded for this minute")


def _routed(spark: SparkSession, root: str) -> DataFrame:
    k = F.pmod(F.get_json_object("props", "$.k").try_cast("int"), F.lit(10))
    loc = F.when(k == 6, F.lit("")).when(k == 7, F.lit(None).cast("string")).otherwise(F.upper("event_type"))
    return table(spark, root, "events").select("event_id", "user_id", loc.alias("loc"))


@register("route_path", "F25 F26", oracle=f"""
SELECT event_id,
       CASE WHEN loc IS NULL OR loc = '' THEN 'http://api.local/data/' ELSE 'http://api.local/data/' || loc END AS url,
       CASE WHEN loc IS NULL THEN NULL ELSE 'solar/' || loc END AS mqtt_topic
FROM (SELECT event_id, {_ROUTE_LOC} AS loc FROM events)
""")
def route_path(spark: SparkSession, root: str) -> DataFrame:
    """HTTP path by location (keyless path when empty) and MQTT topic ``root/key`` (NULL key
    -> NULL topic, a reject). Some keys are blanked/nulled by a rule on props.k."""
    e = _routed(spark, root)
    return e.select("event_id", data_path("http://api.local", F.col("loc")).alias("url"),
                    topic_path("solar", F.encode(F.col("loc"), "UTF-8")).alias("mqtt_topic"))


@register("round_trunc", "F15 F16 F17 F18", oracle="""
SELECT l_orderkey, l_linenumber,
       round(l_extendedprice, 1) AS price_1dp,
       CAST(trunc(l_extendedprice) AS INTEGER) AS price_int,
       CAST(round(l_quantity) AS INTEGER) AS qty_int,
       round(CASE WHEN l_discount > 0 THEN l_extendedprice / l_discount ELSE 0.0 END, 6) AS price_per_discount,
       round(greatest(0.2, least(0.8, l_discount * 10.0)), 6) AS discount_clamped
FROM lineitem
""")
def round_trunc(spark: SparkSession, root: str) -> DataFrame:
    """Rounding to 1 decimal, truncation toward zero, integer assignment, safe division, clamp."""
    li = table(spark, root, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     S.round1("l_extendedprice").alias("price_1dp"),
                     S.trunc_int("l_extendedprice").alias("price_int"),
                     S.round_int("l_quantity").alias("qty_int"),
                     F.round(S.safe_divide("l_extendedprice", "l_discount"), 6).alias("price_per_discount"),
                     F.round(S.clamp(F.col("l_discount") * F.lit(10.0), 0.2, 0.8), 6).alias("discount_clamped"))


@register("http_bodies", "K8 F25", oracle=f"""
SELECT event_id, CASE WHEN loc IS NULL OR loc = '' THEN 'http://api.local/data/' ELSE 'http://api.local/data/' || loc END AS url,
       '{{"event_id":' || event_id || ',"user_id":' || user_id || CASE WHEN loc IS NULL THEN '' ELSE ',"location_id":"' || loc || '"' END || '}}' AS body
FROM (SELECT event_id, user_id, {_ROUTE_LOC} AS loc FROM events)
""")
def http_bodies(spark: SparkSession, root: str) -> DataFrame:
    """What is sent over HTTP: the path by location and the whole record as JSON."""
    e = _routed(spark, root).withColumnRenamed("loc", "location_id")
    shaped = http_requests(e, "http://api.local", body_cols=["event_id", "user_id", "location_id"])
    return shaped.select(F.get_json_object("body", "$.event_id").cast("bigint").alias("event_id"), "url", "body")


@register("mqtt_payloads", "K9 F26", oracle=f"""
SELECT event_id, 'solar/' || loc AS topic, '{{"event_id":' || event_id || '}}' AS payload, NULL AS reject
FROM (SELECT event_id, {_ROUTE_LOC} AS loc FROM events) WHERE loc IS NOT NULL
UNION ALL
SELECT event_id, NULL, '{{"event_id":' || event_id || '}}', 'bad_key' FROM (SELECT event_id, {_ROUTE_LOC} AS loc FROM events) WHERE loc IS NULL
""")
def mqtt_payloads(spark: SparkSession, root: str) -> DataFrame:
    """What is published: ``root/key`` and the message's own value; a message without a key is a rejected row."""
    e = _routed(spark, root)
    envelope = as_topic(e, key="loc", value=F.to_json(F.struct("event_id")), topic="readings", offset=F.col("event_id"))
    messages = mqtt_messages(envelope, "solar")
    return messages.select(F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"), "topic", "payload", F.col("_reject").alias("reject"))


@register("delivery_attempts", "T3 T4 T5", oracle="""
SELECT event_id, 1 + (CASE WHEN event_id % 5 = 0 THEN 2 ELSE 0 END) + (CASE WHEN event_id % 7 = 0 THEN 3 ELSE 0 END) + (CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) AS calls
FROM events
""")
def delivery_attempts(spark: SparkSession, root: str) -> DataFrame:
    """Calls that each record took against an endpoint that fails by rule: two lost connections (retried), three
    refusals for load (waited out, not counted as failures), one quota message (told by its text)."""
    ev = table(spark, root, "events").select("event_id")
    policy = DeliveryPolicy(attempts=3, retry_wait_s=0.0, backpressure_wait_s=0.0)
    return deliveries(ev, _Unsteady, ["event_id"], policy, chunk_size=1).select("event_id", "calls")


@register("observed_counts", "P4 A8", oracle="""
SELECT count(*) AS rows, count(*) FILTER (value > 0) AS positive, round(sum(value), 4) AS total FROM events
""")
def observed_counts(spark: SparkSession, root: str) -> DataFrame:
    """A tap counts the rows that pass while they are used for something else; nothing is read twice."""
    seen = Observation("tap")
    ev = table(spark, root, "events").select("value")
    total = tap(ev, seen, F.count_if(F.col("value") > 0).alias("positive")).agg(F.round(F.sum("value"), 4).alias("total")).first()["total"]
    return spark.createDataFrame([(seen.get["rows"], seen.get["positive"], total)], "rows long, positive long, total double")
