"""Envelope, decode and sink-layout queries over the readings topic (see ``readings``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.functions.timefn import (event_time, hour_of_day, iso_utc, ms_to_timestamp, ns_to_timestamp, timestamp_to_ms,
                                        timestamp_to_ns, to_ntz)
from heliolake.operators.codec import REJECT, Field, decode, good_rows
from heliolake.operators.layouts import (ROW_COLUMNS, SYMBOL_COLUMNS, broker_columns, shape_columnar,
                                         shape_relational, shape_sheet, shape_timeseries)
from heliolake.plans.readings import readings_topic
from heliolake.plans.registry import register
from heliolake.sinks.lines import line_protocol, measurement_lines
from heliolake.tables import table

# SQL view of the readings topic payloads, field by field (mirrors ``readings.readings_topic``).
_D = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events),
d AS (
  SELECT event_id, ts, user_id, k, value,
         k NOT IN (2, 3) AS obj,
         upper(event_type) || '-P' || lpad(CAST(user_id AS VARCHAR),
               greatest(4, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS panel_id,
         upper(event_type) AS location_id, event_type AS location_name, value AS power_output,
         CASE WHEN k IN (0, 5) THEN NULL WHEN k = 4 THEN 12.5 ELSE CAST(k AS DOUBLE) END AS temperature,
         CASE WHEN value > 0 THEN 'OK' ELSE 'STANDBY' END AS inverter_status,
         CASE WHEN k = 1 THEN NULL ELSE epoch_us(ts) * 1000 END AS ts_ns,
         CASE WHEN k IN (2, 3) THEN 'not_a_json_object' WHEN k = 5 THEN 'bad_temperature' END AS reason
  FROM e)
"""


def _int(x: str) -> str:
    return f"CAST(round({x}) AS INTEGER)"


@register("envelope_roundtrip", "E1 E2 E4 S4", oracle="""
SELECT event_id AS kafka_offset, upper(event_type) AS kafka_key, 'solar-data' AS kafka_topic,
       CAST(user_id % 8 AS INTEGER) AS kafka_partition, date_trunc('millisecond', ts) AS kafka_timestamp,
       upper(event_type) || '-P' || lpad(CAST(user_id AS VARCHAR),
             greatest(4, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS panel_id,
       value AS power_output, CAST(json_extract(props, '$.k') AS DOUBLE) AS temperature,
       epoch_us(ts) * 1000 AS timestamp
FROM events
""")
def envelope_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Encode every event as a keyed JSON message, decode it back with broker metadata."""
    topic = readings_topic(spark, root)
    fields = [Field("panel_id"), Field("power_output", "double"), Field("temperature", "double"),
              Field("timestamp", "long")]
    d = decode(topic.select("*", *broker_columns()), fields,
               keep=["kafka_offset", "kafka_key", "kafka_topic", "kafka_partition", "kafka_timestamp"])
    return good_rows(d).withColumn("kafka_timestamp", to_ntz("kafka_timestamp"))


@register("decode_lookups", "E2 E3 P6 P7 P8 P9", oracle=_D + """
SELECT event_id AS offset,
       CASE WHEN obj THEN temperature END AS temp_get,
       CASE WHEN NOT obj THEN NULL WHEN k = 5 THEN NULL WHEN k = 0 THEN NULL ELSE temperature END AS temp_default,
       CASE WHEN NOT obj THEN NULL WHEN k IN (0, 5) OR temperature = 0 THEN -1.0 ELSE temperature END AS temp_falsy,
       CASE WHEN NOT obj THEN NULL WHEN k = 1 THEN -1 ELSE ts_ns // 1000 END AS ts_us_default,
       CASE WHEN k IN (2, 3) THEN 'not_a_json_object' WHEN k = 5 THEN 'bad_temp_get' END AS _reject
FROM d
""")
def decode_lookups(spark: SparkSession, root: str) -> DataFrame:
    """The three lookup rules side by side on payloads with nulls, absent keys and junk."""
    topic = readings_topic(spark, root, edge=True)
    fields = [Field("temp_get", "double", key="temperature"),
              Field("temp_default", "double", lookup="default", default=-1.0, key="temperature"),
              Field("temp_falsy", "double", lookup="falsy", default=-1.0, key="temperature"),
              Field("ts_default", "long", lookup="default", default=-1, key="timestamp")]
    d = decode(topic, fields, keep=["offset"])
    # µs keeps the value exact in float64 consumers (ns epochs exceed 2**53)
    from heliolake.functions.timefn import floor_div
    return d.select("offset", "temp_get", "temp_default", "temp_falsy",
                    floor_div("ts_default", 1000).alias("ts_us_default"), REJECT)


@register("coerce_reject", "P9 E3", oracle=_D + """
SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n FROM d GROUP BY 1
""")
def coerce_reject(spark: SparkSession, root: str) -> DataFrame:
    """Good vs rejected message counts by reason (the reject side output, aggregated)."""
    d = shape_relational(readings_topic(spark, root, edge=True))
    return d.groupBy(F.coalesce(F.col(REJECT), F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@register("ns_to_ts", "F1 F2 F4 F8", oracle="""
SELECT event_id,
       epoch_us(ts) * 1000 + event_id % 1000 AS ns,
       make_timestamp(epoch_us(ts)) AS ts_from_ns,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_from_ms,
       epoch_us(ts) * 1000 AS ns_back,
       round(((epoch_us(ts) // 1000000) % 86400) / 3600.0, 6) AS hour
FROM events
""")
def ns_to_ts(spark: SparkSession, root: str) -> DataFrame:
    """ns/ms epochs <-> timestamps with exact integer arithmetic (sub-µs digits truncated)."""
    ev = table(spark, root, "events")
    ns = timestamp_to_ns("ts") + F.pmod(F.col("event_id"), F.lit(1000))
    out = ev.select("event_id", ns.alias("ns"), timestamp_to_ms("ts").alias("ms"))
    return out.select("event_id", "ns",
                      to_ntz(ns_to_timestamp("ns")).alias("ts_from_ns"),
                      to_ntz(ms_to_timestamp("ms")).alias("ts_from_ms"),
                      timestamp_to_ns(ns_to_timestamp("ns")).alias("ns_back"),
                      F.round(hour_of_day("ns"), 6).alias("hour"))


@register("iso_time", "F3", oracle="""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events
""")
def iso_time(spark: SparkSession, root: str) -> DataFrame:
    ev = table(spark, root, "events")
    return ev.select("event_id", iso_utc(F.col("ts")).alias("iso"))


@register("event_time_fallback", "F5 F6 P8", oracle=_D + """
SELECT event_id AS offset,
       CASE WHEN NOT obj THEN NULL WHEN ts_ns IS NULL THEN date_trunc('millisecond', ts)
            ELSE make_timestamp(ts_ns // 1000) END AS t_broker,
       CASE WHEN NOT obj THEN NULL WHEN ts_ns IS NULL THEN TIMESTAMP '1970-01-01'
            ELSE make_timestamp(ts_ns // 1000) END AS t_epoch
FROM d
""")
def event_time_fallback(spark: SparkSession, root: str) -> DataFrame:
    """Event time with a fallback: broker time (columnar sink) vs epoch 0 (relational sink)."""
    topic = readings_topic(spark, root, edge=True).withColumn("_ms", F.unix_millis("timestamp"))
    d = decode(topic, [Field("ts_falsy", "long", lookup="falsy", default=0, key="timestamp"),
                       Field("ts_absent0", "long", lookup="default", default=0, key="timestamp")],
               keep=["offset", "_ms"])
    return d.select("offset",
                    to_ntz(F.when(F.col(REJECT).isNull(), event_time("ts_falsy", "_ms", "broker"))).alias("t_broker"),
                    to_ntz(F.when(F.col(REJECT).isNull(), event_time("ts_absent0", on_missing="epoch"))).alias("t_epoch"))


@register("sink_rows_18_int", "P5 P7 F1 F6", oracle=_D + f"""
SELECT event_id AS offset,
       CASE WHEN obj THEN panel_id END AS panel_id, CASE WHEN obj THEN location_id END AS location_id,
       CASE WHEN obj THEN location_name END AS location_name,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS INTEGER) AS timezone,
       CASE WHEN obj THEN {_int('power_output')} END AS power_output,
       CASE WHEN obj THEN 'W' END AS unit_power,
       CASE WHEN obj THEN temperature END AS temperature, CAST(NULL AS VARCHAR) AS unit_temp,
       CAST(NULL AS INTEGER) AS irradiance, CAST(NULL AS VARCHAR) AS unit_irradiance,
       CAST(NULL AS DOUBLE) AS voltage, CAST(NULL AS VARCHAR) AS unit_voltage,
       CAST(NULL AS INTEGER) AS current, CAST(NULL AS VARCHAR) AS unit_current,
       CASE WHEN obj THEN inverter_status END AS inverter_status,
       CASE WHEN NOT obj THEN NULL WHEN ts_ns IS NULL THEN TIMESTAMP '1970-01-01'
            ELSE make_timestamp(ts_ns // 1000) END AS timestamp,
       reason AS _reject
FROM d
""")
def sink_rows_18_int(spark: SparkSession, root: str) -> DataFrame:
    """Relational upsert layout (18 columns, integers rounded, NULL when absent)."""
    shaped = shape_relational(readings_topic(spark, root, edge=True), keep=["offset"])
    return shaped.withColumn("timestamp", to_ntz("timestamp"))


_COLUMNAR_SQL = _D + f"""
SELECT CASE WHEN obj THEN panel_id END AS panel_id, CASE WHEN obj THEN location_id END AS location_id,
       CASE WHEN obj THEN location_name END AS location_name,
       CASE WHEN obj THEN 0.0 END AS latitude, CASE WHEN obj THEN 0.0 END AS longitude,
       CASE WHEN obj THEN 0 END AS timezone,
       CASE WHEN obj THEN {_int('power_output')} END AS power_output,
       CASE WHEN obj THEN 'W' END AS unit_power,
       CASE WHEN obj THEN temperature END AS temperature, CASE WHEN obj THEN '' END AS unit_temp,
       CASE WHEN obj THEN 0 END AS irradiance, CASE WHEN obj THEN '' END AS unit_irradiance,
       CASE WHEN obj THEN 0.0 END AS voltage, CASE WHEN obj THEN '' END AS unit_voltage,
       CASE WHEN obj THEN 0 END AS current, CASE WHEN obj THEN '' END AS unit_current,
       CASE WHEN obj THEN inverter_status END AS inverter_status,
       CASE WHEN NOT obj THEN NULL WHEN ts_ns IS NULL THEN date_trunc('millisecond', ts)
            ELSE date_trunc('millisecond', make_timestamp(ts_ns // 1000)) END AS timestamp,
       date_trunc('millisecond', ts) AS kafka_timestamp,
       upper(event_type_k) AS kafka_key, 'solar-data' AS kafka_topic,
       CAST(user_id % 8 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
       reason AS _reject
FROM (SELECT d.*, ev.event_type AS event_type_k FROM d JOIN events ev USING (event_id))
"""


@register("sink_rows_23", "P5 P6 E4 F5", oracle=_COLUMNAR_SQL)
def sink_rows_23(spark: SparkSession, root: str) -> DataFrame:
    """Columnar append layout: defaults only for absent keys, broker metadata, ms time."""
    s = shape_columnar(readings_topic(spark, root, edge=True))
    return s.withColumn("timestamp", to_ntz("timestamp")).withColumn("kafka_timestamp", to_ntz("kafka_timestamp"))


@register("sheet_rows_20", "P5 P6 E5", oracle=_D + """
SELECT event_id AS offset,
       CASE WHEN obj THEN panel_id END AS panel_id, CASE WHEN obj THEN location_id END AS location_id,
       CASE WHEN obj THEN location_name END AS location_name,
       CASE WHEN obj THEN '' END AS latitude, CASE WHEN obj THEN '' END AS longitude,
       CASE WHEN obj THEN '' END AS timezone,
       CASE WHEN obj THEN CAST(power_output AS VARCHAR) END AS power_output,
       CASE WHEN obj THEN 'W' END AS unit_power,
       CASE WHEN NOT obj OR k = 0 THEN NULL WHEN k = 4 THEN '12.5' WHEN k = 5 THEN 'abc'
            ELSE CAST(CAST(k AS DOUBLE) AS VARCHAR) END AS temperature,
       CASE WHEN obj THEN '' END AS unit_temp,
       CASE WHEN obj THEN '' END AS irradiance, CASE WHEN obj THEN '' END AS unit_irradiance,
       CASE WHEN obj THEN '' END AS voltage, CASE WHEN obj THEN '' END AS unit_voltage,
       CASE WHEN obj THEN '' END AS current, CASE WHEN obj THEN '' END AS unit_current,
       CASE WHEN obj THEN inverter_status END AS inverter_status,
       CASE WHEN NOT obj THEN NULL WHEN ts_ns IS NULL THEN '' ELSE CAST(ts_ns AS VARCHAR) END AS timestamp,
       epoch_us(ts) // 1000 AS kafka_timestamp, '' AS stream_id,
       CASE WHEN NOT obj THEN 'not_a_json_object' END AS _reject
FROM d
""")
def sheet_rows_20(spark: SparkSession, root: str) -> DataFrame:
    """Spreadsheet layout: 18 values as sent ('' when absent) + broker ms + stream id."""
    return _sheet_with_offset(readings_topic(spark, root, edge=True))


def _sheet_with_offset(t: DataFrame) -> DataFrame:
    return shape_sheet(t, keep=["offset"])


_TS_SQL = _D + """
SELECT event_id AS offset,
       CASE WHEN obj THEN panel_id END AS panel_id, CASE WHEN obj THEN location_id END AS location_id,
       CASE WHEN obj THEN location_name END AS location_name,
       CASE WHEN obj THEN inverter_status END AS inverter_status,
       CASE WHEN obj THEN 0.0 END AS latitude, CASE WHEN obj THEN 0.0 END AS longitude,
       CASE WHEN obj THEN 0 END AS timezone, CASE WHEN obj THEN power_output END AS power_output,
       CASE WHEN obj THEN temperature END AS temperature, CASE WHEN obj THEN 0.0 END AS irradiance,
       CASE WHEN obj THEN 0.0 END AS voltage, CASE WHEN obj THEN 0.0 END AS current,
       CASE WHEN obj AND ts_ns IS NOT NULL THEN make_timestamp(ts_ns // 1000) END AS time,
       CASE WHEN NOT obj THEN 'not_a_json_object' WHEN k = 5 THEN 'bad_temperature'
            WHEN k = 0 THEN 'missing_temperature' WHEN ts_ns IS NULL THEN 'missing_timestamp' END AS _reject
FROM d
"""


@register("timeseries_rows", "P5 P9", oracle=_TS_SQL)
def timeseries_rows(spark: SparkSession, root: str) -> DataFrame:
    """Time-series row layout: 4 symbols, 8 forced numbers, designated time; bad rows rejected."""
    s = shape_timeseries(readings_topic(spark, root, edge=True), keep=["offset"])
    return s.withColumn("time", to_ntz("time"))


@register("line_protocol", "K5 F3", oracle=_D + """
SELECT event_id AS offset,
       'solar,panel_id=' || panel_id || ',location_id=' || location_id || ',location_name=' || location_name
       || ',inverter_status=' || inverter_status
       || ' latitude=0.0,longitude=0.0,timezone=0i,power_output=' || CAST(power_output AS VARCHAR)
       || ',temperature=' || CAST(temperature AS VARCHAR)
       || ',irradiance=0.0,voltage=0.0,current=0.0 ' || CAST(ts_ns AS VARCHAR) AS line
FROM d WHERE obj AND k NOT IN (0, 5) AND ts_ns IS NOT NULL
""")
def line_protocol_q(spark: SparkSession, root: str) -> DataFrame:
    """Good time-series rows rendered as line protocol (time in ns)."""
    t = readings_topic(spark, root, edge=True)
    from heliolake.operators.layouts import timeseries_fields
    d = good_rows(decode(t, timeseries_fields(), keep=["offset"])).filter(
        F.col("timestamp").isNotNull() & (F.col("timestamp") != 0))
    return d.select("offset", line_protocol(d, "solar", SYMBOL_COLUMNS, ROW_COLUMNS, "timestamp").alias("line"))


@register("union_producers", "U1 U3 E2", oracle="""
SELECT upper(event_type) AS location_id, count(*) AS n, count(power_output) AS n_power,
       count(temperature) AS n_temperature
FROM (SELECT event_type,
             CASE WHEN event_type IN ('click', 'view') THEN value END AS power_output,
             CASE WHEN event_type NOT IN ('click', 'view') THEN CAST(json_extract(props, '$.k') AS DOUBLE) END
               AS temperature
      FROM events)
GROUP BY 1
""")
def union_producers(spark: SparkSession, root: str) -> DataFrame:
    """Two producers write one topic with different payload fields; the consumer unions the
    decoded streams by name, widening the schema (absent columns are NULL)."""
    from heliolake.plans.readings import reading_columns
    from heliolake.sources.topic import as_topic
    r = reading_columns(table(spark, root, "events"))
    a = r.filter(F.col("location_name").isin("click", "view"))
    b = r.filter(~F.col("location_name").isin("click", "view"))
    ta = as_topic(a, key=F.col("location_id"), topic="solar-data", offset=F.col("event_id"), timestamp=F.col("ts"),
                  value=F.to_json(F.struct("location_id", "power_output")))
    tb = as_topic(b, key=F.col("location_id"), topic="solar-data", offset=F.col("event_id"), timestamp=F.col("ts"),
                  value=F.to_json(F.struct("location_id", F.col("_k").cast("double").alias("temperature"))))
    da = good_rows(decode(ta, [Field("location_id"), Field("power_output", "double")]))
    db = good_rows(decode(tb, [Field("location_id"), Field("temperature", "double")]))
    u = da.unionByName(db, allowMissingColumns=True)
    return u.groupBy("location_id").agg(F.count(F.lit(1)).alias("n"), F.count("power_output").alias("n_power"),
                                        F.count("temperature").alias("n_temperature"))


@register("measurement_lines", "K6", oracle=_D + """
SELECT 'readings,panel_id=' || panel_id || ',status=' || inverter_status || ' offset=' || event_id || 'i,power=' || CAST(power_output AS VARCHAR) || ' '
       || CAST(coalesce(ts_ns, epoch_us(ts) * 1000) AS VARCHAR) AS line
FROM d WHERE reason IS NULL
""")
def measurement_lines_q(spark: SparkSession, root: str) -> DataFrame:
    """A measurement with configured tags and fields; a message without a time takes the broker's."""
    t = readings_topic(spark, root, edge=True).withColumnRenamed("timestamp", "broker_time")
    d = good_rows(decode(t, [Field("panel_id"), Field("status", key="inverter_status"), Field("power", "double", key="power_output"),
                             Field("temperature", "double"), Field("time_ns", "long", key="timestamp")], keep=["offset", "broker_time"]))
    return measurement_lines(d, "readings", ["panel_id", "status"], ["offset", "power"], time_col="time_ns", broker_time_col="broker_time")


@register("event_time_now", "F7", oracle=_D + """
SELECT event_id AS offset, ts_ns IS NULL AS is_now, CASE WHEN ts_ns IS NOT NULL THEN make_timestamp(ts_ns // 1000) END AS t
FROM d WHERE reason IS NULL
""")
def event_time_now(spark: SparkSession, root: str) -> DataFrame:
    """A missing time becomes the processing time (opt-in, not replayable): told here as "within a day of this run"."""
    d = good_rows(decode(readings_topic(spark, root, edge=True), [Field("temperature", "double"), Field("ns", "long", key="timestamp")], keep=["offset"]))
    t = event_time("ns", on_missing="now")
    is_now = F.abs(F.unix_seconds(t) - F.unix_seconds(F.current_timestamp())) < 86_400
    return d.select("offset", is_now.alias("is_now"), F.when(~is_now, to_ntz(t)).alias("t"))
