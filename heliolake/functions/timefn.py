"""Event-time conversions (ns / ms epochs <-> timestamps).

All conversions use exact integer arithmetic (no float seconds), so a nanosecond epoch maps
to the microsecond it falls in, and the session zone is pinned to UTC by ``session``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from heliolake.functions import _col

NS_PER_US = 1_000
NS_PER_S = 1_000_000_000
SECONDS_PER_DAY = 86_400

# ISO-8601 text with microseconds and a literal Z (UTC)
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def floor_div(x, d: int) -> Column:
    """Exact floor division of an integral column by a positive constant (``x // d``)."""
    x = _col(x).cast("bigint")
    return F.call_function("div", x - F.pmod(x, F.lit(d)), F.lit(d))


def ns_to_timestamp(ns) -> Column:
    """F1: nanosecond epoch -> TIMESTAMP (UTC instant), truncated to the microsecond."""
    return F.timestamp_micros(floor_div(ns, NS_PER_US))


def ms_to_timestamp(ms) -> Column:
    """millisecond epoch (broker time) -> TIMESTAMP."""
    return F.timestamp_millis(_col(ms).cast("bigint"))


def timestamp_to_ns(ts) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> nanosecond epoch (bigint)."""
    return F.unix_micros(_col(ts).cast("timestamp")) * F.lit(NS_PER_US)


def timestamp_to_ms(ts) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


def iso_utc(ts) -> Column:
    """timestamp -> ``YYYY-MM-DDTHH:MM:SS.ffffffZ`` text in UTC."""
    return F.date_format(_col(ts).cast("timestamp"), ISO_UTC_FORMAT)


def event_time(ns, broker_ms=None, on_missing: str = "broker") -> Column:
    """event time from an ns epoch with a fallback when it is missing.

    ``on_missing``:
      * ``"broker"`` — missing, null or 0 -> broker timestamp (ms epoch)          (F5)
      * ``"epoch"``  — missing/null -> 1970-01-01 (the ns value defaults to 0)       (F6)
      * ``"now"``    — missing/null/0 -> processing time; not replayable, opt-in     (F7)
    """
    ns = _col(ns)
    if on_missing == "broker":
        if broker_ms is None:
            raise ValueError("on_missing='broker' needs the broker timestamp column")
        return F.when(ns.isNull() | (ns == 0), ms_to_timestamp(broker_ms)).otherwise(ns_to_timestamp(ns))
    if on_missing == "epoch":
        return ns_to_timestamp(F.coalesce(ns, F.lit(0)))
    if on_missing == "now":
        return F.when(ns.isNull() | (ns == 0), F.current_timestamp()).otherwise(ns_to_timestamp(ns))
    raise ValueError(f"unknown on_missing policy: {on_missing!r}")


def hour_of_day(ns) -> Column:
    """F8: fractional UTC hour of day (0 <= h < 24) of an ns epoch."""
    secs = floor_div(ns, NS_PER_S)
    return F.pmod(secs, F.lit(SECONDS_PER_DAY)).cast("double") / F.lit(3600.0)


def to_ntz(ts) -> Column:
    """Wall-clock (UTC) TIMESTAMP_NTZ of an instant — the form stored in naive-time tables."""
    return _col(ts).cast("timestamp_ntz")
