"""Time-series line protocol (``measurement,tags fields time``) built as a string column.

Escaping follows the line-protocol rules: measurement — comma and space; tag keys/values and
field keys — comma, equals sign and space; string field values — double quote and backslash.
NULL or empty tags and NULL fields are left out; a row with no field gives a NULL line.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegerType, LongType, ShortType

from heliolake.functions import _col
from heliolake.functions.timefn import timestamp_to_ns


def _esc(s: Column, chars: str) -> Column:
    """Backslash-escape each of ``chars`` (literal replaces, backslash first; no regex)."""
    for ch in sorted(chars, key=lambda c: c != "\\"):
        s = F.replace(s, F.lit(ch), F.lit("\\" + ch))
    return s


def _field_value(c: Column, dtype) -> Column:
    if isinstance(dtype, (IntegerType, LongType, ShortType)):
        return F.concat(c.cast("string"), F.lit("i"))
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.cast("string")
    if isinstance(dtype, BooleanType):
        return F.when(c, F.lit("true")).otherwise(F.lit("false"))
    return F.concat(F.lit('"'), _esc(c.cast("string"), '"\\'), F.lit('"'))


def line_protocol(df: DataFrame, measurement, tags: Sequence[str], fields: Sequence[str],
                  time_col: str | None = None) -> Column:
    """K5/K6: one line-protocol record per row (time in ns; omitted when ``time_col`` is None)."""
    meas = _esc(_col(measurement) if isinstance(measurement, Column) else F.lit(measurement), ", ")
    tag_parts = [F.when(F.col(t).isNotNull() & (F.col(t).cast("string") != ""),
                        F.concat(F.lit(_esc_lit(t)), F.lit("="), _esc(F.col(t).cast("string"), ",= ")))
                 for t in tags]
    field_parts = [F.when(F.col(f).isNotNull(),
                          F.concat(F.lit(_esc_lit(f)), F.lit("="), _field_value(F.col(f), df.schema[f].dataType)))
                   for f in fields]
    tag_txt = F.concat_ws(",", *tag_parts) if tag_parts else F.lit("")
    field_txt = F.concat_ws(",", *field_parts)
    head = F.when(tag_txt == "", meas).otherwise(F.concat(meas, F.lit(","), tag_txt))
    line = F.concat(head, F.lit(" "), field_txt)
    if time_col:
        t = F.col(time_col)
        ns = t if isinstance(df.schema[time_col].dataType, LongType) else timestamp_to_ns(t)
        line = F.when(ns.isNull(), line).otherwise(F.concat(line, F.lit(" "), ns.cast("string")))
    return F.when(field_txt == "", F.lit(None).cast("string")).otherwise(line)


def measurement_lines(df: DataFrame, measurement: str, tags: Sequence[str], fields: Sequence[str], *, time_col: str | None = None,
                      broker_time_col: str = "timestamp") -> DataFrame:
    """K6: a configured measurement: given tags and fields, and the row's time or else the broker's.

    ``time_col`` (ns epoch) may be absent, null or 0 in a row; then the broker's time stands in. Returns ``line``.
    """
    broker = timestamp_to_ns(F.col(broker_time_col))
    t = F.coalesce(F.when(F.col(time_col) != 0, F.col(time_col)), broker) if time_col else broker
    timed = df.withColumn("_line_time", t.cast("bigint"))
    return timed.select(line_protocol(timed, measurement, tags, fields, "_line_time").alias("line"))


def _esc_lit(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in ",= " else ch)
    return "".join(out)
