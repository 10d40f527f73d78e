"""File-source queries: driver tables written as CSV / JSON / text by Spark into folders named by a
key, then read back with the file sources; the folder in ``source_file`` must be the row's own key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heliolake.operators.codec import Field, decode, good_rows
from heliolake.plans.registry import register
from heliolake.session import unique_dir
from heliolake.sources.files import csv_preview, folder_stats, folder_topic, read_csv, read_json, read_text
from heliolake.sources.topic import read_topic, write_topic
from heliolake.tables import table


def _folder() -> Column:
    """The folder part of the object name."""
    return F.regexp_extract("source_file", "^(.*)/[^/]+$", 1)


@register("csv_source", "S5 S7 S11", oracle="""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || ', "the ' || c_mktsegment || '"' || chr(10) || 'second line' ELSE c_name END AS c_name,
       c_acctbal, '' AS c_phone, 'seg ment=' || c_mktsegment AS folder
FROM customer
""")
def csv_source(spark: SparkSession, root: str) -> DataFrame:
    """customer -> CSV files (header, columns in another order, a quoted comma in the header; commas, quotes and line
    breaks in fields; a blank in the folder's name) -> read by header name; an absent column takes its default."""
    path = unique_dir(spark, "csv_source")
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(', "the '), "c_mktsegment", F.lit('"\nsecond line'))).otherwise(F.col("c_name"))
    c = table(spark, root, "customer").select(F.col("c_mktsegment").alias("seg ment"), F.col("c_acctbal").alias("balance, in all"), name.alias("c_name"), "c_custkey")
    c.write.partitionBy("seg ment").option("header", "true").option("escape", '"').csv(path)
    cols = {"c_custkey": ("bigint", 0), "c_name": ("string", ""), "balance, in all": ("double", 0.0), "c_phone": ("string", "")}
    back = read_csv(spark, path, cols)
    return back.filter(F.col("_reject").isNull()).select("c_custkey", "c_name", F.col("balance, in all").alias("c_acctbal"), "c_phone", _folder().alias("folder"))


@register("csv_rejects", "S7 S11", oracle="""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'bad_balance' WHEN c_custkey % 5 = 1 THEN 'bad_balance' END AS reject FROM customer
""")
def csv_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Empty and non-numeric values reject their own row only; the rows after them are kept."""
    path = unique_dir(spark, "csv_rejects")
    k = F.col("c_custkey") % 5
    balance = F.when(k == 0, F.lit("")).when(k == 1, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    table(spark, root, "customer").select("c_custkey", balance.alias("balance")).write.option("header", "true").csv(path)
    back = read_csv(spark, path, {"c_custkey": ("bigint", 0), "balance": ("double", 0.0)})
    return back.select("c_custkey", F.col("_reject").alias("reject"))


@register("jsonl_source", "S8c S11 E2", oracle="""
SELECT event_id, ts, user_id, event_type, value, props, 'event_type=' || event_type AS folder FROM events
""")
def jsonl_source(spark: SparkSession, root: str) -> DataFrame:
    """events -> JSON-lines files -> classified and read line by line -> typed columns."""
    path = unique_dir(spark, "jsonl_source")
    ev = table(spark, root, "events")
    (ev.withColumn("kind", F.col("event_type")).withColumnRenamed("event_type", "t").withColumnRenamed("kind", "event_type")
     .write.partitionBy("event_type").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
    names = "event_id bigint, ts timestamp_ntz, user_id bigint, t string, value double, props string"
    back = read_json(spark, path, schema=names)
    parsed = back.filter(F.col("_reject").isNull()).select(F.from_json("value", names).alias("r"), _folder().alias("folder"))
    return parsed.select("r.event_id", "r.ts", "r.user_id", F.col("r.t").alias("event_type"), "r.value", "r.props", "folder")


@register("json_files_source", "S5 S8a S8b S8c S11", oracle="""
SELECT event_id, event_type, value, CASE event_id % 3 WHEN 0 THEN 'kind=array' WHEN 1 THEN 'kind=pretty' ELSE 'kind=lines' END AS folder FROM events
WHERE event_id NOT IN (SELECT min(event_id) FROM events GROUP BY event_type)
UNION ALL SELECT event_id, event_type, value, 'kind=object' FROM events WHERE event_id IN (SELECT min(event_id) FROM events GROUP BY event_type)
UNION ALL SELECT NULL, CASE event_id % 60 WHEN 0 THEN 'not_an_object' ELSE 'invalid_json_line' END, NULL, CASE event_id % 60 WHEN 0 THEN 'kind=array' ELSE 'kind=lines' END FROM events
WHERE event_id % 60 IN (0, 2) AND event_id NOT IN (SELECT min(event_id) FROM events GROUP BY event_type)
""")
def json_files_source(spark: SparkSession, root: str) -> DataFrame:
    """events -> JSON files of four kinds (compact arrays, pretty-printed arrays, JSON lines, a single object in a
    file) -> one folder read. Arrays are assembled per chunk of ids. Some hold elements that are no objects, some line files bad lines, and
    some records a field of over 1 MB; the rejected ones come with their reason as ``event_type``."""
    path = unique_dir(spark, "json_files")
    ev = table(spark, root, "events").select("event_id", "event_type", "value")
    firsts = ev.groupBy("event_type").agg(F.min_by(F.struct("event_id", "value"), "event_id").alias("f"))
    alone = firsts.select(F.lit("object").alias("kind"), F.to_json(F.struct("f.event_id", "event_type", "f.value"), {"pretty": "true"}).alias("text"), F.col("f.event_id").alias("chunk"))
    rest = ev.join(firsts.select(F.col("f.event_id").alias("event_id")), "event_id", "left_anti")
    kind = F.element_at(F.array(F.lit("array"), F.lit("pretty"), F.lit("lines")), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    pad = F.when(F.col("event_id") % 20_000 == 11, F.repeat(F.lit("x[,"), 400_000)).alias("pad")
    records = F.collect_list(F.struct("event_id", "event_type", "value", pad))
    chunks = rest.groupBy(kind.alias("kind"), F.expr("event_id div 16384").alias("chunk")).agg(records.alias("rows"))
    spoilt = lambda rest, bad: lambda r: F.concat(F.to_json(r), F.when(r["event_id"] % 60 == rest, F.lit(bad)).otherwise(F.lit("")))
    text = (F.when(F.col("kind") == "array", F.concat(F.lit("["), F.array_join(F.transform("rows", spoilt(0, ",3")), ","), F.lit("]")))
            .when(F.col("kind") == "pretty", F.to_json("rows", {"pretty": "true"})).otherwise(F.array_join(F.transform("rows", spoilt(2, "\nbad")), "\n")))
    files = chunks.select("kind", text.alias("text"), "chunk").unionByName(alone)
    # one record a file, since a file holds one array or object
    files.repartition("kind", "chunk").select("kind", F.col("text").alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("kind").text(path)
    names = "event_id bigint, event_type string, value double"
    back = read_json(spark, path, extension="txt", schema=names)
    parsed = back.select(F.when(F.col("_reject").isNull(), F.from_json("value", names)).alias("r"), "_reject", _folder().alias("folder"))
    return parsed.select("r.event_id", F.coalesce("_reject", "r.event_type").alias("event_type"), "r.value", "folder")


@register("text_source", "S9 S10 S11 F28 S6", oracle="""
SELECT content, folder FROM (
  SELECT regexp_replace(unnest(string_split(text, chr(10))),
         '^[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x85\\p{Z}]+|[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x85\\p{Z}]+$', '', 'g') AS content,
         'utf8/lang=' || lang AS folder
  FROM documents WHERE lang <> 'fr') WHERE content <> ''
""")
def text_source(spark: SparkSession, root: str) -> DataFrame:
    """documents -> text files of two encodings -> non-blank stripped lines of every file with any extension; files that
    are not UTF-8 (the French ones, written in another encoding) are skipped whole."""
    path = unique_dir(spark, "text_source")
    docs = table(spark, root, "documents")
    docs.filter("lang <> 'fr'").select("text", "lang").write.partitionBy("lang").text(f"{path}/utf8")
    docs.filter("lang = 'fr'").select("text").write.option("encoding", "UTF-16LE").json(f"{path}/other")
    return read_text(spark, path, "none").select("content", _folder().alias("folder"))


@register("folder_preview", "S12 S13", oracle="""
WITH f AS (SELECT min(c_mktsegment) AS s FROM customer)
SELECT c_custkey, c_name, 'c_custkey,c_name' AS header, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS files, true AS has_bytes
FROM customer WHERE c_mktsegment = (SELECT s FROM f) ORDER BY c_custkey LIMIT 100
""")
def folder_preview(spark: SparkSession, root: str) -> DataFrame:
    """Header and first 100 rows of the first CSV file by name, number of files and their size (the limit is the feature)."""
    path = unique_dir(spark, "folder_preview")
    c = table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")
    c.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey").write.partitionBy("c_mktsegment").option("header", "true").csv(path)
    header, rows, stats = csv_preview(spark, path, n=100)
    return rows.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", F.lit(",".join(header)).alias("header"),
                       stats.select("files").scalar().alias("files"), (stats.select("bytes").scalar() > 0).alias("has_bytes"))


@register("file_counts", "S13 A8 S14", oracle="""
SELECT (SELECT count(DISTINCT c_mktsegment) FROM customer) AS files, count(*) AS rows_read, 0 AS rows_of_empty FROM customer
""")
def file_counts(spark: SparkSession, root: str) -> DataFrame:
    """Files of a folder and rows read from them (the source's counters), besides an empty folder that yields none."""
    path, empty = unique_dir(spark, "file_counts"), unique_dir(spark, "file_counts_empty")
    c = table(spark, root, "customer").select("c_custkey", "c_mktsegment")
    c.repartition("c_mktsegment").write.partitionBy("c_mktsegment").option("header", "true").csv(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(empty)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    count = lambda d: read_csv(spark, d, {"c_custkey": ("bigint", 0)}).agg(F.count(F.lit(1)))
    return folder_stats(spark, path, "csv").select("files", count(path).scalar().alias("rows_read"), count(empty).scalar().cast("int").alias("rows_of_empty"))


@register("folder_to_topic", "S11 F29 K1 S4 E1 E2 X3", oracle="""
SELECT 'o_orderstatus=' || o_orderstatus AS folder, o_orderkey, o_totalprice, true AS key_is_file FROM orders
""")
def folder_to_topic(spark: SparkSession, root: str) -> DataFrame:
    """Every record of a folder becomes a message: key = file name, ``source_file`` merged into the value; the topic is read back."""
    path, topic = unique_dir(spark, "folder"), unique_dir(spark, "topic")
    table(spark, root, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").json(path)
    messages, _ = folder_topic(spark, path, "files", "json", schema="o_orderkey bigint, o_totalprice double")
    write_topic(messages, path=topic)
    back = good_rows(decode(read_topic(spark, "files", path=topic, stream=False), [Field("o_orderkey", "long"), Field("o_totalprice", "double"), Field("source_file")], keep=["key"]))
    return back.select(_folder().alias("folder"), "o_orderkey", "o_totalprice", (F.col("key").cast("string") == F.col("source_file")).alias("key_is_file"))
