"""Generic scalar helpers: safe division, clamp, rounding, truncation, status of a power."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from heliolake.functions import _col


def _d(x: float) -> Column:
    return F.lit(float(x))


def safe_divide(num, den) -> Column:
    """num/den when den > 0, else 0.0; NULL stays NULL (ANSI mode raises on /0)."""
    n, d = _col(num), _col(den)
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when(d > _d(0.0), n.cast("double") / d.cast("double"))
            .otherwise(_d(0.0)))


def clamp(x, lo=None, hi=None) -> Column:
    """F16: max(lo, min(hi, x)); NULL in -> NULL out (greatest/least would skip the NULL)."""
    x = _col(x)
    out = x
    if hi is not None:
        out = F.least(F.lit(hi), out)
    if lo is not None:
        out = F.greatest(F.lit(lo), out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def round1(x) -> Column:
    """round to one decimal (HALF_UP on the decimal value, as SQL engines do)."""
    return F.round(_col(x), 1)


def trunc_int(x) -> Column:
    """truncate toward zero to INT; out-of-range -> NULL instead of an ANSI error."""
    return _col(x).try_cast("int")


def round_int(x) -> Column:
    """Assignment of a fractional number to an INTEGER column: round half away from zero."""
    return F.round(_col(x)).try_cast("int")


def inverter_status(power) -> Column:
    """'OK' when the (unrounded) power is > 0, else 'STANDBY'."""
    p = _col(power)
    return F.when(p.isNull(), F.lit(None).cast("string")).when(p > 0, F.lit("OK")).otherwise(F.lit("STANDBY"))
