"""Helpers shared by the corpus operators: tables, shared folders, hash-sketch blocks, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.session import unique_dir

#: The word of the corpus contracts: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch handed to Python; whole texts are long, so batches are kept short.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table ``name`` under ``sf_dir``, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, unless the session says otherwise already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, ARROW_ROWS)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Cuts the lineage with files that every executor sees, so a lost executor costs only its own
    tasks, and non-deterministic columns (row numbers) keep their values.
    """
    path = unique_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def slots(spark: SparkSession) -> int:
    """Partitions for work that Python does on narrow rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
