"""Dimension lookup, rejects, text lines and preview queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.functions.text import STRIP_PATTERN
from heliolake.operators.lookup import key_report, lookup, rejects
from heliolake.plans.registry import register
from heliolake.sources.files import text_lines
from heliolake.tables import table

SERVED_REGION = "EUROPE"


def _served_locations(spark: SparkSession, root: str) -> DataFrame:
    """Location dimension: the nations of the served region (upper-case ids)."""
    n = table(spark, root, "nation")
    r = table(spark, root, "region").filter(F.col("r_name") == SERVED_REGION)
    return n.join(r, n.n_regionkey == r.r_regionkey, "left_semi").select(
        F.upper("n_name").alias("location_id"), "n_nationkey", "n_regionkey")


def _probe(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "customer")
    # the key arrives in mixed case: "Nation_7"
    return c.select("c_custkey", F.initcap(F.concat(F.lit("nation_"), F.col("c_nationkey"))).alias("location"))


_DIM_SQL = f"""
WITH dim AS (SELECT upper(n_name) AS location_id, n_nationkey, n_regionkey FROM nation
             WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = '{SERVED_REGION}')),
probe AS (SELECT c_custkey, 'Nation_' || CAST(c_nationkey AS VARCHAR) AS location FROM customer)
"""


@register("dimension_lookup", "J1 F20", oracle=_DIM_SQL + """
SELECT c_custkey, location, location_id, n_nationkey, n_regionkey
FROM probe JOIN dim ON upper(probe.location) = dim.location_id
""")
def dimension_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Attach location attributes by a case-insensitive key (no hint: joined by measured size)."""
    return lookup(_probe(spark, root), _served_locations(spark, root), "location", "location_id")


@register("dimension_rejects", "P13 J1", oracle=_DIM_SQL + """
SELECT c_custkey, location FROM probe WHERE upper(location) NOT IN (SELECT location_id FROM dim)
""")
def dimension_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Probe rows whose location is not in the dimension (the reject path of the lookup)."""
    return rejects(_probe(spark, root), _served_locations(spark, root), "location", "location_id")


@register("dimension_key_report", "P13", oracle=_DIM_SQL + """
SELECT DISTINCT 'invalid' AS kind, location AS key FROM probe WHERE upper(location) NOT IN (SELECT location_id FROM dim)
UNION ALL SELECT DISTINCT 'valid', location_id FROM dim
""")
def dimension_key_report(spark: SparkSession, root: str) -> DataFrame:
    """Every invalid key of the probe and every valid key of the dimension, none left out."""
    return key_report(_probe(spark, root), _served_locations(spark, root), "location", "location_id")


_WS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"


@register("text_lines", "S9 F28", oracle=f"""
SELECT source_file, line_no, content FROM (
  SELECT CAST(doc_id AS VARCHAR) AS source_file,
         regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') AS content, line_no
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(generate_series(1, len(string_split(text, chr(10))))) AS line_no
        FROM documents))
WHERE content <> ''
""")
def text_lines_q(spark: SparkSession, root: str) -> DataFrame:
    """Every document split on newlines, stripped, blank lines dropped (whole texts)."""
    docs = table(spark, root, "documents").select(F.col("doc_id").cast("string").alias("source_file"), "text")
    return text_lines(docs, text_col="text", source_col="source_file")


@register("preview_limit", "S12 O3", oracle="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 100
""")
def preview_limit(spark: SparkSession, root: str) -> DataFrame:
    """Preview: the first 100 rows by key (top-k, no full sort; the limit is the feature)."""
    return table(spark, root, "customer").orderBy("c_custkey").limit(100)


assert STRIP_PATTERN == f"^{_WS}+|{_WS}+$"
