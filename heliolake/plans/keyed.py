"""Keyed queries: last-writer-wins, keyed upsert across batches, per-key age, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.operators.latest import key_age_seconds, latest_per_key
from heliolake.plans.registry import register
from heliolake.session import unique_dir
from heliolake.sinks.table import KeyedTable, append_table
from heliolake.tables import table

_LATEST_SQL = """
SELECT user_id, event_type, event_id, ts, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
"""


@register("upsert_latest", "W1", oracle=_LATEST_SQL)
def upsert_latest(spark: SparkSession, root: str) -> DataFrame:
    """Last writer wins per primary key (user_id, event_type) in arrival (offset) order."""
    ev = table(spark, root, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(ev, ["user_id", "event_type"], ["event_id"])


@register("upsert_many_batches", "K3 T12 W1", oracle=_LATEST_SQL)
def upsert_many_batches(spark: SparkSession, root: str) -> DataFrame:
    """Keyed upsert in batches that overlap, one of them replayed, with compaction in between; the
    highest event id wins, so reading back equals the one-pass result."""
    ev = table(spark, root, "events").select("user_id", "event_type", "event_id", "ts", "value")
    t = KeyedTable(unique_dir(spark, "upsert"), keys=["user_id", "event_type"], order=["event_id"], batch_wins=False, compact_every=2)
    third = F.pmod(F.col("event_id"), F.lit(3))
    for batch_id, rows in enumerate((third == 2, third <= 1, third >= 1)):
        t.upsert(ev.filter(rows), batch_id)
    t.upsert(ev.filter(third >= 1), 2)      # replaying a batch changes nothing
    return t.read().select("user_id", "event_type", "event_id", "ts", "value")


@register("key_age", "W2", oracle="""
SELECT event_id, user_id,
       epoch_us(ts) // 1000000 - min(epoch_us(ts) // 1000000) OVER (PARTITION BY user_id) AS age_s
FROM events
""")
def key_age(spark: SparkSession, root: str) -> DataFrame:
    """Seconds since each panel's first reading."""
    ev = table(spark, root, "events").select("event_id", "user_id", "ts")
    return key_age_seconds(ev, "user_id", "ts").select("event_id", "user_id", "age_s")


@register("daily_layout", "O2 K4", oracle="""
SELECT CAST(ts AS DATE) AS event_date, count(*) AS n, min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events GROUP BY 1
""")
def daily_layout(spark: SparkSession, root: str) -> DataFrame:
    """Write readings date-partitioned and sorted by (panel, time); read back, count per day
    (the daily partition folders are pruned by a date filter on read)."""
    ev = table(spark, root, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = unique_dir(spark, "daily_layout")
    append_table(ev, path, time_col="ts", sort_by=["user_id", "ts"])
    back = spark.read.parquet(path)
    return back.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_offset"),
                                          F.max("event_id").alias("last_offset"))


@register("sorted_files", "O1 O2", oracle="""
SELECT CAST(ts AS DATE) AS event_date, 0 AS out_of_order, count(*) AS n FROM events GROUP BY 1
""")
def sorted_files(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every written file, in file order: how many come before their predecessor in (panel, time)."""
    ev = table(spark, root, "events").select("event_id", "ts", "user_id")
    path = unique_dir(spark, "sorted_files")
    append_table(ev, path, time_col="ts", sort_by=["user_id", "ts"])
    rows = spark.read.parquet(path).select("event_date", "user_id", "ts", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    # each row beside the next one of its file: an equi-join, so no file is one task's window
    here = rows.select("f", F.col("i").alias("j"), F.struct("user_id", "ts").alias("here"))
    pairs = rows.withColumn("j", F.col("i") - 1).join(here, ["f", "j"], "left")
    wrong = F.coalesce(F.struct("user_id", "ts") < F.col("here"), F.lit(False)).cast("int")
    return pairs.groupBy("event_date").agg(F.sum(wrong).cast("int").alias("out_of_order"), F.count(F.lit(1)).alias("n"))
