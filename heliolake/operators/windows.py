"""Time-range filters and tumbling-window aggregates of dashboard series.

Semantics of the dashboard's ``range |> filter |> aggregateWindow(every, fn, createEmpty:false)``:

* ``range(start, stop)`` keeps ``start <= t < stop``;
* windows are aligned to the Unix epoch (Spark's ``window`` does the same);
* one output row per (series, window) that holds at least one non-null value — empty windows
  are omitted (``createEmpty: false``) and ``last``/``mean`` ignore NULLs;
* the output time is the window *stop*, clipped to the range stop.

``last`` is ``max_by(value, (time, offset))`` — deterministic when times tie — and both
aggregates run as partial (map-side) + final aggregation, so a hot series costs one row per
window per input partition in the shuffle, never all of its rows.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


FUNCTIONS = ("last", "mean")


def time_range(df: DataFrame, start=None, stop=None, time_col: str = "_time") -> DataFrame:
    """``start <= t < stop`` (either bound may be None; a Column, such as a scalar subquery, is taken as it is).

    On a column of the stored table the filter reaches the parquet scan; on a decoded time it cannot, see
    :func:`broker_range`.
    """
    t = F.col(time_col)
    cond = None
    if start is not None:
        cond = t >= _ts_lit(start, df, time_col)
    if stop is not None:
        c = t < _ts_lit(stop, df, time_col)
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def broker_range(topic: DataFrame, start, stop, slack: str = "1 hour", time_col: str = "timestamp") -> DataFrame:
    """Messages whose broker time is within ``slack`` of ``[start, stop)``, as a filter that reaches the topic's scan.

    It goes before decoding. ``slack`` states how far an event time may be from its broker time; rows
    beyond that would be missed, so it belongs to the topic's contract.
    """
    t, wide = F.col(time_col), F.expr(f"INTERVAL {slack}")
    at = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast(topic.schema[time_col].dataType)
    return topic.filter((t >= at(start) - wide) & (t < at(stop) + wide))


def last_order(time: Column, order: Column | None = None) -> Column:
    """Time, then ``order`` (an integer such as an offset), as one decimal number.

    A number can be updated in place in a hash aggregation; a struct cannot, and would make Spark sort the whole input.
    """
    micros = F.unix_micros(time.cast("timestamp")).cast("decimal(18,0)")
    if order is None:
        return micros.cast("decimal(38,0)")
    return (micros * F.lit("10000000000000000000").cast("decimal(20,0)") + order.cast("decimal(19,0)")).cast("decimal(38,0)")


def _ts_lit(v, df: DataFrame, time_col: str) -> Column:
    if isinstance(v, Column):
        return v
    dtype = df.schema[time_col].dataType.simpleString()
    return F.lit(v).cast(dtype)


def aggregate_window(df: DataFrame, every: str, fn: str = "last", *, time_col: str = "_time",
                     value_col: str = "_value", series: Sequence[str] = (),
                     order_col: str | None = None, start=None, stop=None,
                     out_time: str = "_time", out_value: str = "_value") -> DataFrame:
    """Tumbling-window ``last`` or ``mean`` per series.

    ``order_col`` (an integer) breaks ties among equal times for ``last`` (e.g. the message offset). Numeric values
    plan as a HashAggregate; text values have to be sorted.
    """
    if fn not in FUNCTIONS:
        raise ValueError(f"fn must be one of {FUNCTIONS}")
    src = time_range(df, start, stop, time_col).filter(F.col(value_col).isNotNull())
    w = F.window(F.col(time_col), every)
    if fn == "last":
        agg = F.max_by(F.col(value_col), last_order(F.col(time_col), F.col(order_col) if order_col else None))
    else:
        agg = F.avg(F.col(value_col))
    grouped = src.groupBy(*[F.col(s) for s in series], w.alias("_w")).agg(agg.alias(out_value))
    end = F.col("_w.end")
    if stop is not None:
        end = F.least(end, _ts_lit(stop, df, time_col))
    return grouped.select(*series, end.alias(out_time), out_value)


def last_not_null(df: DataFrame, *, time_col: str = "_time", value_col: str = "_value",
                  series: Sequence[str] = (), order_col: str | None = None,
                  start=None, stop=None) -> DataFrame:
    """A4: the panel reducer ``lastNotNull`` over the selected range, per series."""
    src = time_range(df, start, stop, time_col).filter(F.col(value_col).isNotNull())
    order = last_order(F.col(time_col), F.col(order_col) if order_col else None)
    return src.groupBy(*series).agg(F.max_by(F.col(time_col), order).alias(time_col),
                                    F.max_by(F.col(value_col), order).alias(value_col))


def footer_sum(df: DataFrame, columns: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    """A5: table-footer ``sum`` reducer over numeric columns (NULLs ignored)."""
    return df.groupBy(*group_by).agg(*[F.sum(F.col(c)).alias(c) for c in columns])


def yield_all(results: Mapping[str, DataFrame], name_col: str = "result") -> DataFrame:
    """Several named results of one panel as one DataFrame with a ``result`` column."""
    out = None
    for name, frame in results.items():
        tagged = frame.withColumn(name_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def to_series(df: DataFrame, time_col: str, measurement: str, fields: Sequence[str],
              tags: Sequence[str] = ()) -> DataFrame:
    """Wide rows -> long dashboard series ``(_measurement, tags.., _field, _value, _time)``.

    Uses ``stack`` (one Generate node, no shuffle); all ``fields`` must share one type.
    """
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    return df.select(F.lit(measurement).alias("_measurement"), *tags, F.col(time_col).alias("_time"),
                     F.expr(f"stack({len(fields)}, {pairs}) as (_field, _value)"))


def relative_range(minutes: float = 15.0, now=None) -> tuple[Column, Column]:
    """The dashboard's default range ``[now - minutes, now)`` as two timestamp columns.

    ``now`` (a literal or Column) pins the end for replayable runs; by default it is the
    query's start time (``current_timestamp``, one value for the whole query).
    """
    end = (F.lit(now).cast("timestamp") if now is not None and not isinstance(now, Column)
           else (now if now is not None else F.current_timestamp()))
    start = end - F.make_interval(mins=F.lit(0), secs=F.lit(float(minutes) * 60.0))
    return start, end
