"""String helpers: identifiers, paths, whitespace."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from heliolake.functions import _col

# Whitespace as Python's str.strip() sees it: ASCII controls \t\n\v\f\r, the separators
# \x1c-\x1f, NEL \x85 and every Unicode space/line/paragraph separator (category Z).
# The same class text works in Java regex and in RE2 (used by the SQL oracles).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
STRIP_PATTERN = f"^{WS_CLASS}+|{WS_CLASS}+$"


def strip(s) -> Column:
    """remove leading/trailing whitespace (Spark's trim() only removes spaces)."""
    return F.regexp_replace(_col(s), STRIP_PATTERN, "")


def upper_key(s) -> Column:
    """case-insensitive key normalisation."""
    return F.upper(_col(s))


def zfill(n, width: int = 4) -> Column:
    """Python ``str(n).zfill(width)``: pad with zeros after the sign, never truncate."""
    s = _col(n).cast("string")
    neg = s.startswith("-")
    digits = F.when(neg, F.substring(s, 2, 1 << 30)).otherwise(s)
    body_w = F.when(neg, F.lit(width - 1)).otherwise(F.lit(width))
    padded = F.lpad(digits, F.greatest(body_w, F.length(digits)), "0")
    return F.when(neg, F.concat(F.lit("-"), padded)).otherwise(padded)


def panel_id(location_id, number, width: int = 4) -> Column:
    """``{LOCATION}-P{n:04}`` — e.g. LONDON-P0001; 5+ digit numbers are kept whole."""
    return F.concat(_col(location_id), F.lit("-P"), zfill(number, width))


def data_path(base_url: str, key) -> Column:
    """``base/data/{key}`` when the key is non-empty, else ``base/data/``."""
    k = _col(key)
    root = F.lit(base_url.rstrip("/") + "/data/")
    return F.when(k.isNull() | (k == ""), root).otherwise(F.concat(root, k))


def topic_path(root: str, key_bytes) -> Column:
    """``root/key`` with the binary key decoded as UTF-8.

    NULL when the key is NULL or not valid UTF-8 (the caller routes those rows to rejects).
    """
    k = _col(key_bytes)
    txt = k.cast("string")
    return F.when(k.isNull() | ~F.is_valid_utf8(txt), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(root + "/"), txt))
