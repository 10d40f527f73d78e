"""Dashboard presentation: value mappings and threshold colours, as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from heliolake.functions import _col

# ---- fixed values (dashboard configuration) -------------------------------------------------
STATUS_TEXT = {0: "Not working", 1: "Good"}
# threshold steps: (lower bound or None for the base step, colour); a value takes the colour of
# the highest step whose bound it reaches
STATUS_STEPS = [(None, "dark-red"), (0.5, "green")]
LEVEL_STEPS = [(None, "green"), (80.0, "red")]
# ---------------------------------------------------------------------------------------------


def map_values(x, mapping: dict) -> Column:
    """exact value -> text mapping; unmapped values give NULL."""
    x = _col(x)
    out = None
    for k, v in mapping.items():
        out = (F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(None).cast("string"))


def threshold_colour(x, steps=STATUS_STEPS) -> Column:
    """F32: absolute thresholds. NULL value -> NULL colour."""
    x = _col(x)
    base = steps[0][1]
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for bound, colour in sorted((s for s in steps[1:]), key=lambda s: -s[0]):
        expr = expr.when(x >= F.lit(bound), F.lit(colour))
    return expr.otherwise(F.lit(base))
