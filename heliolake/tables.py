"""Access to the input tables (one parquet dataset per table name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    How many tasks read it is for ``spark.sql.files.maxPartitionBytes`` and the files' row groups; no shuffle is added.
    """
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
