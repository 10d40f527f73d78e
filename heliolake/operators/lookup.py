"""Dimension lookup (location attributes by a case-insensitive key) and its reject path.

The joins carry no hint: Spark broadcasts a dimension whose measured bytes are below
``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle beyond that, splitting skewed keys.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F


def _normalised(dim: DataFrame, dim_key: str, prefer: Sequence[str] | None) -> DataFrame:
    """One row per upper-cased key: the first by ``prefer`` order (default: the key text)."""
    k = F.upper(F.col(dim_key)).alias("_lk")
    order = F.struct(*[F.col(c) for c in (prefer or [dim_key])])
    others = [c for c in dim.columns]
    return (dim.groupBy(k).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_d"))
            .select("_lk", *[F.col(f"_d.{c}").alias(c) for c in others]))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, *, how: str = "inner",
           prefer: Sequence[str] | None = None) -> DataFrame:
    """Attach dimension columns where ``upper(df.key) == upper(dim.dim_key)``.

    Duplicate keys in the dimension (case-insensitively) resolve to the first by ``prefer``.
    ``how='inner'`` drops misses — pair it with :func:`rejects` to keep them.
    """
    return (df.withColumn("_lk", F.upper(F.col(key)))
            .join(_normalised(dim, dim_key, prefer), on="_lk", how=how).drop("_lk"))


def rejects(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows whose key has no match in the dimension (left anti join)."""
    keys = dim.select(F.upper(F.col(dim_key)).alias("_lk")).distinct()
    return (df.withColumn("_lk", F.upper(F.col(key)))
            .join(keys, on="_lk", how="left_anti").drop("_lk"))


def key_report(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Every invalid key once, and every valid one: ``(kind, key)`` with ``invalid`` / ``valid``."""
    bad = rejects(df.select(key).distinct(), dim, key, dim_key).select(F.lit("invalid").alias("kind"), F.col(key).cast("string").alias("key"))
    return bad.unionByName(dim.select(F.lit("valid").alias("kind"), F.col(dim_key).cast("string").alias("key")).distinct())


def validate_keys(df: DataFrame, dim: DataFrame, key: str, dim_key: str, report_path: str | None = None, shown: int = 20) -> None:
    """Raise ``ValueError`` when a key is not in the dimension.

    The message counts the invalid keys and shows the first ``shown`` of them; ``report_path``, if given, receives
    all of them and all valid ones (:func:`key_report`) as a table.
    """
    bad = rejects(df.select(key).distinct(), dim, key, dim_key)
    n = bad.count()
    if not n:
        return
    if report_path:
        key_report(df, dim, key, dim_key).write.partitionBy("kind").parquet(report_path)
    first = ", ".join(f"'{r[0]}'" for r in bad.orderBy(key).limit(shown).collect())
    raise ValueError(f"{n} invalid {key}: {first}" + (" ..." if n > shown else "")
                     + (f"; all invalid and valid keys are in {report_path}" if report_path else ""))
