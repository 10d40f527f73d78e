"""Column -> Column helpers (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c
