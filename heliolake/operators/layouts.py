"""Sink row layouts (P5): which fields, which lookup rule, which types, per destination.

Each layout is a list of :class:`~heliolake.operators.codec.Field` plus envelope columns; the
``shape_*`` functions turn topic messages into rows of that layout with a ``_reject`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heliolake.functions.timefn import event_time, ns_to_timestamp, ms_to_timestamp
from heliolake.operators.codec import Field, REJECT, decode

# ---- fixed values: the canonical reading (18 fields, producer order) -----------------------
READING_FIELDS = [
    ("panel_id", "string"), ("location_id", "string"), ("location_name", "string"),
    ("latitude", "double"), ("longitude", "double"), ("timezone", "int"),
    ("power_output", "double"), ("unit_power", "string"),
    ("temperature", "double"), ("unit_temp", "string"),
    ("irradiance", "double"), ("unit_irradiance", "string"),
    ("voltage", "double"), ("unit_voltage", "string"),
    ("current", "double"), ("unit_current", "string"),
    ("inverter_status", "string"), ("timestamp", "long"),
]
# columns stored as INTEGER by the relational/columnar tables although the producer sends
# one-decimal numbers: assignment rounds half away from zero
INTEGER_COLUMNS = ("timezone", "power_output", "irradiance", "current")
BROKER_COLUMNS = ["kafka_timestamp", "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset"]
SYMBOL_COLUMNS = ["panel_id", "location_id", "location_name", "inverter_status"]
ROW_COLUMNS = ["latitude", "longitude", "timezone", "power_output", "temperature", "irradiance",
               "voltage", "current"]
# ---------------------------------------------------------------------------------------------

NAMES_18 = [n for n, _ in READING_FIELDS]


def relational_fields() -> list[Field]:
    """Upsert table: ``get(k)`` (NULL when absent), integers rounded; the primary key
    ``(panel_id, timestamp)`` must be present — timestamp defaults to 0 only when absent."""
    out = []
    for name, dtype in READING_FIELDS:
        if name == "timestamp":
            out.append(Field(name, "long", lookup="default", default=0, required=True))
        elif name == "panel_id":
            out.append(Field(name, "string", required=True))
        else:
            out.append(Field(name, "int_round" if name in INTEGER_COLUMNS else dtype))
    return out


def _has_payload() -> Column:
    return F.col(REJECT).isNull() | ~F.col(REJECT).isin("not_a_json_object", "null_value")


def shape_relational(topic: DataFrame, keep=()) -> DataFrame:
    """18-column upsert layout; ``timestamp`` is the event instant (epoch 0 when absent)."""
    d = decode(topic, relational_fields(), keep=keep)
    ts = F.when(_has_payload(), event_time(F.col("timestamp"), on_missing="epoch"))
    return d.select(*keep, *[c for c in NAMES_18 if c != "timestamp"], ts.alias("timestamp"), REJECT)


def _columnar_default(name: str, dtype: str):
    if dtype == "string":
        return ""
    return 0 if name in INTEGER_COLUMNS else 0.0


def columnar_fields() -> list[Field]:
    """Append table: ``get(k, default)`` — default only when absent; timestamp is falsy-coalesced."""
    out = []
    for name, dtype in READING_FIELDS:
        if name == "timestamp":
            out.append(Field(name, "long", lookup="falsy", default=0))
        else:
            out.append(Field(name, "int_round" if name in INTEGER_COLUMNS else dtype,
                             lookup="default", default=_columnar_default(name, dtype)))
    return out


def broker_columns() -> list:
    """Broker metadata; a NULL key becomes ''. The key is shown as decoded text."""
    return [ms_to_timestamp(F.unix_millis(F.col("timestamp"))).alias("kafka_timestamp"),
            F.coalesce(F.col("key").cast("string"), F.lit("")).alias("kafka_key"),
            F.col("topic").alias("kafka_topic"),
            F.col("partition").cast("int").alias("kafka_partition"),
            F.col("offset").cast("bigint").alias("kafka_offset")]


def shape_columnar(topic: DataFrame, keep=()) -> DataFrame:
    """23-column append layout: the 18 + broker metadata; event time falls back to broker time."""
    src = topic.withColumn("_broker_ms", F.unix_millis(F.col("timestamp")))
    d = decode(src.select(*src.columns, *broker_columns()), columnar_fields(),
               keep=[*keep, "_broker_ms", *BROKER_COLUMNS])
    ts = F.when(_has_payload(), event_time(F.col("timestamp"), F.col("_broker_ms"), on_missing="broker"))
    return d.select(*keep, *[c for c in NAMES_18 if c != "timestamp"], F.date_trunc("millisecond", ts).alias("timestamp"),
                    *BROKER_COLUMNS, REJECT)


def sheet_fields() -> list[Field]:
    """Spreadsheet rows: every field as JSON text, '' when absent (explicit null stays empty)."""
    return [Field(name, "string", lookup="default", default="") for name in NAMES_18]


def shape_sheet(topic: DataFrame, keep=()) -> DataFrame:
    """20-column spreadsheet layout: the 18 as text + broker ms + ``stream_id`` ('' when absent)."""
    d = decode(topic.withColumn("_broker_ms", F.unix_millis(F.col("timestamp"))), sheet_fields(),
               keep=[*keep, "_broker_ms"])
    return d.select(*keep, *NAMES_18, F.col("_broker_ms").alias("kafka_timestamp"), F.lit("").alias("stream_id"),
                    REJECT)


def timeseries_fields() -> list[Field]:
    """Time-series rows: symbols default ''; numbers are forced (float()/int()) — an explicit
    null or non-number makes the row bad."""
    out = [Field(s, "string", lookup="default", default="") for s in SYMBOL_COLUMNS]
    for name in ROW_COLUMNS:
        out.append(Field(name, "int" if name == "timezone" else "double", lookup="default",
                         default=0 if name == "timezone" else 0.0, required=True))
    out.append(Field("timestamp", "long"))
    return out


def shape_timeseries(topic: DataFrame, now_fallback: bool = False, keep=()) -> DataFrame:
    """Symbols + float/int columns + designated time (ns event time; processing time only
    when ``now_fallback`` — otherwise a row without a usable time is rejected)."""
    d = decode(topic, timeseries_fields(), keep=keep)
    ns = F.col("timestamp")
    usable = ns.isNotNull() & (ns != 0)
    t = F.when(usable, ns_to_timestamp(ns))
    if now_fallback:
        t = t.otherwise(F.current_timestamp())
    reason = F.coalesce(F.col(REJECT), F.when(t.isNull(), F.lit("missing_timestamp")))
    return d.select(*keep, *SYMBOL_COLUMNS, *ROW_COLUMNS, t.alias("time"), reason.alias(REJECT))

