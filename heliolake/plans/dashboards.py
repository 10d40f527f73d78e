"""Dashboard queries: range -> filter -> tumbling window last/mean, reducers, named results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heliolake.functions.presentation import LEVEL_STEPS, STATUS_STEPS, STATUS_TEXT, map_values, threshold_colour
from heliolake.functions.timefn import event_time, to_ntz
from heliolake.operators.codec import Field, decode, good_rows
from heliolake.operators.windows import (aggregate_window, broker_range, footer_sum, last_not_null, last_order, relative_range, time_range, to_series,
                                         yield_all)
from heliolake.plans.readings import readings_topic
from heliolake.plans.registry import register
from heliolake.session import unique_dir
from heliolake.sinks.table import append_table
from heliolake.tables import table

EVERY = "1 hour"


def whole_range(spark: SparkSession, root: str) -> tuple[Column, Column]:
    """The whole days that the events table covers, as two scalar subqueries over its own times."""
    ev = table(spark, root, "events")
    day = lambda f: F.date_trunc("day", f("ts")).cast("timestamp_ntz")
    return ev.agg(day(F.min)).scalar(), ev.agg(day(F.max) + F.expr("INTERVAL 1 DAY")).scalar()

SERIES_FIELDS = [Field("location_id"), Field("power_output", "double"), Field("temperature", "double"),
                 Field("inverter_status"), Field("timestamp", "long")]


def series(spark: SparkSession, root: str, edge: bool = False, within: tuple[Column, Column] | None = None) -> DataFrame:
    """Decoded readings with an event time (broker time when the payload has none).

    ``within`` skips messages by their broker time before decoding; a reading's own time is its broker time here.
    """
    topic = readings_topic(spark, root, edge=edge)
    if within:
        topic = broker_range(topic, *within)
    d = good_rows(decode(topic.withColumn("_broker_ms", F.unix_millis("timestamp")), SERIES_FIELDS,
                         keep=["offset", "_broker_ms"]))
    return d.withColumn("_time", to_ntz(event_time(F.col("timestamp"), F.col("_broker_ms"), "broker")))


def _bucket(every_sql: str = "INTERVAL '1 hour'") -> str:
    return f"time_bucket({every_sql}, ts, TIMESTAMP '1970-01-01') + {every_sql}"


_RANGE_SQL = "ts >= (SELECT date_trunc('day', min(ts)) FROM events) AND ts < (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM events)"


@register("window_last", "E2 F1 P10 A1 A3", oracle=f"""
SELECT upper(event_type) AS location_id, {_bucket()} AS _time, value AS _value
FROM events WHERE {_RANGE_SQL} AND value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_type, {_bucket()} ORDER BY ts DESC, event_id DESC) = 1
""")
def window_last(spark: SparkSession, root: str) -> DataFrame:
    start, stop = whole_range(spark, root)
    s = series(spark, root).select("location_id", "_time", "offset", F.col("power_output").alias("_value"))
    return aggregate_window(s, EVERY, "last", series=["location_id"], order_col="offset",
                            start=start, stop=stop)


@register("window_last_zero", "P10 A1 A3", oracle=f"""
SELECT upper(event_type) AS location_id, {_bucket()} AS _time,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS _value
FROM events WHERE {_RANGE_SQL} AND CAST(json_extract(props, '$.k') AS INTEGER) = 0
QUALIFY row_number() OVER (PARTITION BY event_type, {_bucket()} ORDER BY ts DESC, event_id DESC) = 1
""")
def window_last_zero(spark: SparkSession, root: str) -> DataFrame:
    """The alert panel: last value per window among readings whose value equals 0."""
    start, stop = whole_range(spark, root)
    s = series(spark, root).select("location_id", "_time", "offset", F.col("temperature").alias("_value"))
    s = s.filter(F.col("_value") == 0.0)
    return aggregate_window(s, EVERY, "last", series=["location_id"], order_col="offset",
                            start=start, stop=stop)


@register("window_last_text", "P10 A1 A3", oracle=f"""
SELECT upper(event_type) AS location_id, {_bucket()} AS _time,
       CASE WHEN value > 0 THEN 'OK' ELSE 'STANDBY' END AS _value
FROM events WHERE {_RANGE_SQL} AND value > 0
QUALIFY row_number() OVER (PARTITION BY event_type, {_bucket()} ORDER BY ts DESC, event_id DESC) = 1
""")
def window_last_text(spark: SparkSession, root: str) -> DataFrame:
    """The alerts table: string equality on a text field, then last per window."""
    start, stop = whole_range(spark, root)
    s = series(spark, root).select("location_id", "_time", "offset", F.col("inverter_status").alias("_value"))
    s = s.filter(F.col("_value") == "OK")
    return aggregate_window(s, EVERY, "last", series=["location_id"], order_col="offset",
                            start=start, stop=stop)


_MEAN_SQL = f"""
SELECT location_id, _field, _time, round(avg(_value), 6) AS _value FROM (
  SELECT upper(event_type) AS location_id, 'power_output' AS _field, {_bucket()} AS _time, value AS _value
  FROM events WHERE {_RANGE_SQL}
  UNION ALL
  SELECT upper(event_type), 'temperature', {_bucket()}, CAST(json_extract(props, '$.k') AS DOUBLE)
  FROM events WHERE {_RANGE_SQL}
) WHERE _value IS NOT NULL GROUP BY location_id, _field, _time
"""


def _long_series(s: DataFrame) -> DataFrame:
    return s.select("location_id", "_time", "offset",
                    F.expr("stack(2, 'power_output', power_output, 'temperature', temperature) as (_field, _value)"))


@register("window_mean", "P11 A2 A3", oracle=_MEAN_SQL)
def window_mean(spark: SparkSession, root: str) -> DataFrame:
    """Mean per window of two fields (``_field == a or _field == b``)."""
    start, stop = whole_range(spark, root)
    s = _long_series(series(spark, root))
    s = s.filter((F.col("_field") == "power_output") | (F.col("_field") == "temperature"))
    out = aggregate_window(s, EVERY, "mean", series=["location_id", "_field"], start=start, stop=stop)
    return out.withColumn("_value", F.round("_value", 6))


_EDGE_K = "CAST(json_extract(props, '$.k') AS INTEGER)"


@register("last_not_null", "A4 E3 F5", oracle=f"""
SELECT upper(event_type) AS location_id, ts AS _time,
       CASE WHEN {_EDGE_K} = 4 THEN 12.5 ELSE CAST({_EDGE_K} AS DOUBLE) END AS _value
FROM events
WHERE {_RANGE_SQL} AND {_EDGE_K} NOT IN (0, 2, 3, 5)
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def last_not_null_q(spark: SparkSession, root: str) -> DataFrame:
    """``lastNotNull`` of temperature per location over messages with nulls/bad payloads."""
    start, stop = whole_range(spark, root)
    s = series(spark, root, edge=True).select("location_id", "_time", "offset",
                                             F.col("temperature").alias("_value"))
    return last_not_null(s, series=["location_id"], order_col="offset", start=start, stop=stop)


@register("footer_sum", "A5", oracle="""
SELECT upper(event_type) AS location_id, round(sum(value), 4) AS power_output,
       round(sum(CAST(json_extract(props, '$.k') AS DOUBLE)), 4) AS temperature
FROM events GROUP BY 1
""")
def footer_sum_q(spark: SparkSession, root: str) -> DataFrame:
    out = footer_sum(series(spark, root), ["power_output", "temperature"], group_by=["location_id"])
    return out.select("location_id", F.round("power_output", 4).alias("power_output"),
                      F.round("temperature", 4).alias("temperature"))


@register("multi_yield", "A6 U1", oracle=f"""
SELECT location_id, 'power_output' AS _field, _time, _value, 'last' AS result FROM (
  SELECT upper(event_type) AS location_id, {_bucket()} AS _time, value AS _value
  FROM events WHERE {_RANGE_SQL}
  QUALIFY row_number() OVER (PARTITION BY event_type, {_bucket()} ORDER BY ts DESC, event_id DESC) = 1)
UNION ALL
SELECT location_id, _field, _time, _value, 'mean' AS result FROM ({_MEAN_SQL})
""")
def multi_yield(spark: SparkSession, root: str) -> DataFrame:
    """Two named results of one panel (``last`` power, ``mean`` of two fields) from ONE decode
    and ONE shuffle: a single aggregation per (location, window) computes all three series,
    then ``stack`` emits them as named rows; a series whose window holds only NULLs is dropped
    (createEmpty: false)."""
    start, stop = whole_range(spark, root)
    s = time_range(series(spark, root), start, stop, "_time")
    p, t = F.col("power_output"), F.col("temperature")
    agg = (s.groupBy("location_id", F.window("_time", EVERY).alias("_w"))
           .agg(F.max_by(p, F.when(p.isNotNull(), last_order(F.col("_time"), F.col("offset")))).alias("last_p"),
                F.round(F.avg(p), 6).alias("mean_p"), F.round(F.avg(t), 6).alias("mean_t")))
    rows = agg.select("location_id", F.least(F.col("_w.end"), stop).alias("_time"),
                      F.expr("stack(3, 'power_output', last_p, 'last', 'power_output', mean_p, 'mean', "
                             "'temperature', mean_t, 'mean') as (_field, _value, result)"))
    return rows.filter(F.col("_value").isNotNull()).select("location_id", "_field", "_time", "_value", "result")


@register("status_and_thresholds", "A4 F19 F31 F32", oracle="""
WITH last AS (
  SELECT upper(event_type) AS location_id, value,
         CASE WHEN value > 0 THEN 1 ELSE 0 END AS status_value
  FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT location_id, status_value,
       CASE status_value WHEN 0 THEN 'Not working' WHEN 1 THEN 'Good' END AS status_text,
       CASE WHEN status_value >= 0.5 THEN 'green' ELSE 'dark-red' END AS status_colour,
       CASE WHEN value >= 80 THEN 'red' ELSE 'green' END AS level_colour
FROM last
""")
def status_and_thresholds(spark: SparkSession, root: str) -> DataFrame:
    """Gauge panel: lastNotNull status per location -> value mapping -> threshold colours."""
    s = series(spark, root)
    s = s.withColumn("status_value", F.when(F.col("inverter_status") == "OK", 1).otherwise(0))
    last = (s.groupBy("location_id")
            .agg(F.max_by(F.struct("status_value", "power_output"), last_order(F.col("_time"), F.col("offset"))).alias("l")))
    return last.select(
        "location_id", F.col("l.status_value").alias("status_value"),
        map_values(F.col("l.status_value"), STATUS_TEXT).alias("status_text"),
        threshold_colour(F.col("l.status_value"), STATUS_STEPS).alias("status_colour"),
        threshold_colour(F.col("l.power_output"), LEVEL_STEPS).alias("level_colour"))


@register("stored_series_last", "A1 P10 O2 K4", oracle=f"""
SELECT upper(event_type) AS location_id, {_bucket()} AS _time, value AS _value
FROM events WHERE {_RANGE_SQL} AND value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_type, {_bucket()} ORDER BY ts DESC, event_id DESC) = 1
""")
def stored_series_last(spark: SparkSession, root: str) -> DataFrame:
    """Dashboard over a *stored* series table: readings are written once in long form
    (_measurement, location_id, _field, _value, _time, offset), partitioned by day and sorted by
    (field, location, time); the dashboard query then filters field and range on the table, so
    day partitions and parquet row groups outside them are skipped."""
    start, stop = whole_range(spark, root)
    s = series(spark, root)
    long = to_series(s, "_time", "solar",
                     ["power_output", "temperature"], tags=["location_id", "offset"])
    path = unique_dir(spark, "series")
    append_table(long, path, time_col="_time", sort_by=["_field", "location_id", "_time"])
    stored = spark.read.parquet(path)
    q = stored.filter((F.col("event_date") >= start.cast("date")) & (F.col("event_date") <= stop.cast("date"))
                      & (F.col("_measurement") == "solar") & (F.col("_field") == "power_output"))
    return aggregate_window(q, EVERY, "last", series=["location_id"], order_col="offset",
                            start=start, stop=stop)


# a range that cuts: from 90 minutes after the middle of the table's times to 20 minutes past some later hour
_CUT = "(SELECT date_trunc('hour', min(ts) + (max(ts) - min(ts)) / 2) FROM events)"
_CUT_SQL = f"ts >= {_CUT} + INTERVAL 90 MINUTE AND ts < {_CUT} + INTERVAL 1460 MINUTE"


def cut_range(spark: SparkSession, root: str) -> tuple[Column, Column]:
    ev = table(spark, root, "events")
    middle = F.timestamp_micros(F.expr("(unix_micros(cast(min(ts) as timestamp)) + unix_micros(cast(max(ts) as timestamp))) div 2"))
    at = lambda minutes: ev.agg((F.date_trunc("hour", middle) + F.expr(f"INTERVAL {minutes} MINUTE")).cast("timestamp_ntz")).scalar()
    return at(90), at(1460)


@register("window_cut_range", "P12 A7 A1 A2 A6", oracle=f"""
SELECT upper(event_type) AS location_id, least({_bucket()}, {_CUT} + INTERVAL 1460 MINUTE) AS _time, round(value, 6) AS _value, 'last' AS result
FROM events WHERE {_CUT_SQL} AND value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_type, {_bucket()} ORDER BY ts DESC, event_id DESC) = 1
UNION ALL
SELECT upper(event_type), least({_bucket("INTERVAL '15 minutes'")}, {_CUT} + INTERVAL 1460 MINUTE), round(avg(value), 6), 'mean'
FROM events WHERE {_CUT_SQL} AND value IS NOT NULL GROUP BY 1, 2
""")
def window_cut_range(spark: SparkSession, root: str) -> DataFrame:
    """A range inside the data: both bounds cut rows, the first window begins late and the last one is clipped at the stop;
    two window lengths as two named results. Messages outside (by broker time) are skipped before decoding."""
    start, stop = cut_range(spark, root)
    s = series(spark, root, within=(start, stop)).select("location_id", "_time", "offset", F.col("power_output").alias("_value"))
    last = aggregate_window(s, "1 hour", "last", series=["location_id"], order_col="offset", start=start, stop=stop)
    mean = aggregate_window(s, "15 minutes", "mean", series=["location_id"], start=start, stop=stop)
    out = yield_all({"last": last, "mean": mean})
    return out.select("location_id", "_time", F.round("_value", 6).alias("_value"), "result")


@register("window_relative_range", "P12 A7 A2", oracle="""
SELECT upper(event_type) AS location_id, least(time_bucket(INTERVAL '1 minute', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 minute', m) AS _time, round(avg(value), 6) AS _value
FROM events, (SELECT max(ts) AS m FROM events) WHERE ts >= m - INTERVAL 15 MINUTE AND ts < m AND value IS NOT NULL GROUP BY 1, 2
""")
def window_relative_range(spark: SparkSession, root: str) -> DataFrame:
    """The dashboard's default range, the last 15 minutes; "now" is the newest event's time, so that reruns agree."""
    now = table(spark, root, "events").agg(F.max("ts").cast("timestamp")).scalar()
    start, stop = (c.cast("timestamp_ntz") for c in relative_range(15, now=now))
    s = series(spark, root, within=(start, stop)).select("location_id", "_time", F.col("power_output").alias("_value"))
    out = aggregate_window(s, "1 minute", "mean", series=["location_id"], start=start, stop=stop)
    return out.withColumn("_value", F.round("_value", 6))
