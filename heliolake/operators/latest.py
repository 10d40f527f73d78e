"""Keyed "latest" logic: last-writer-wins per primary key, per-key age.

Both are aggregate-shaped (partial + final aggregation), never a window over the whole key:
a key holding a third of all rows still reduces to one row per input partition before the
shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` tuple (e.g. partition, offset).

    ``max_by(struct(non-key columns), struct(order))`` — the same result as
    ``row_number() over (partition by keys order by order desc) = 1`` without sorting the
    whole key in one task.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys).agg(F.max_by(row, ordering).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]))


def key_age_seconds(df: DataFrame, key: str, time_col: str, out: str = "age_s") -> DataFrame:
    """Seconds since the first reading of each key (the generator's per-panel age counter).

    Per-key minimum by partial aggregation, then an equi-join back. The per-key table has
    one row per key; AQE turns the join into a broadcast when that measured table is small and
    splits skewed partitions of the big side otherwise.
    """
    secs = F.unix_seconds(F.col(time_col).cast("timestamp"))
    first = df.groupBy(key).agg(F.min(secs).alias("_first_s"))
    first = first.withColumnRenamed(key, "_first_key")        # a NULL key is a key like others
    return (df.join(first, F.col(key).eqNullSafe(F.col("_first_key")), "left")
            .withColumn(out, secs - F.col("_first_s")).drop("_first_s", "_first_key"))
