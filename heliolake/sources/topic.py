"""Topic scans with the Kafka-source envelope.

Every topic DataFrame — batch or streaming — has the columns Spark's Kafka source produces:
``key binary, value, topic string, partition int, offset bigint, timestamp timestamp``
(+ ``headers`` when asked). ``value`` may be binary (Kafka) or JSON text; decoders take both.

Without a Kafka connector on the classpath a topic can be file-backed: a parquet folder of
envelope rows, written by :func:`write_topic` and read (also as a stream) by :func:`read_topic`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heliolake.functions import _col

ENVELOPE_SCHEMA = ("key binary, value string, topic string, partition int, offset bigint, "
                   "timestamp timestamp, timestampType int")
HEADERS_TYPE = "array<struct<key:string,value:binary>>"


def as_topic(df: DataFrame, *, key, value: Column, topic: str, partition=None,
             offset=None, timestamp=None, headers: Column | None = None) -> DataFrame:
    """Shape any table as topic messages (U1/K1 producer side).

    ``key`` (S4 string key) is stored UTF-8 encoded; ``partition``/``offset``/``timestamp`` are
    column expressions (broker metadata); ``value`` is the encoded payload (see ``codec.encode``);
    ``headers`` (E6) is an optional ``array<struct<key:string,value:binary>>``.
    """
    k = _col(key)
    extra = [headers.cast(HEADERS_TYPE).alias("headers")] if headers is not None else []
    return df.select(
        F.when(k.isNull(), F.lit(None).cast("binary")).otherwise(F.encode(k.cast("string"), "UTF-8")).alias("key"),
        value.cast("string").alias("value"),
        F.lit(topic).alias("topic"),
        (_col(partition) if partition is not None else F.lit(0)).cast("int").alias("partition"),
        (_col(offset) if offset is not None else F.monotonically_increasing_id()).cast("bigint").alias("offset"),
        (_col(timestamp).cast("timestamp") if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *extra,
    )


def key_string(df: DataFrame, col: str = "key") -> Column:
    """The message key as text (``key_deserializer="string"``)."""
    return F.col(col).cast("string")


def has_kafka(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001 - class not on the classpath
        return False


def read_topic(spark: SparkSession, topic: str, *, bootstrap: str | None = None, path: str | None = None,
               stream: bool = True, starting: str = "earliest", max_per_trigger: int | None = None,
               max_bytes_per_trigger: int | None = None,
               include_headers: bool = False, min_partitions: int | None = None) -> DataFrame:
    """Scan a topic from its earliest offset.

    With ``bootstrap`` it is Spark's Kafka source (``startingOffsets`` = S2; consumer position
    per query lives in that query's checkpoint = S3). With ``path`` it is a file-backed topic.
    ``max_per_trigger`` caps a micro-batch (T1: ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``);
    ``max_bytes_per_trigger`` caps a file-backed one by size, which fits files of any number.
    ``min_partitions`` splits large Kafka partitions over more tasks (a hot partition does not
    become one task).
    """
    if bootstrap:
        r = spark.readStream if stream else spark.read
        r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", topic).option("startingOffsets", starting)
             .option("includeHeaders", str(include_headers).lower()))
        if stream and max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", int(max_per_trigger))
        if min_partitions:
            r = r.option("minPartitions", int(min_partitions))
        return r.load()
    if not path:
        raise ValueError("give either bootstrap (Kafka) or path (file-backed topic)")
    schema = ENVELOPE_SCHEMA + (f", headers {HEADERS_TYPE}" if include_headers else "")
    if stream:
        r = spark.readStream.schema(schema)
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", int(max_per_trigger))
        elif max_bytes_per_trigger:
            r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
        df = r.parquet(path)
    else:
        df = spark.read.schema(schema).parquet(path)
    return df.filter(F.col("topic") == F.lit(topic))


def write_topic(df: DataFrame, *, bootstrap: str | None = None, path: str | None = None,
                topic: str | None = None, mode: str = "append") -> None:
    """K1 (batch): produce keyed messages. Kafka when ``bootstrap`` is given, else a parquet
    folder partitioned by topic (the file-backed topic read by :func:`read_topic`)."""
    if bootstrap:
        w = df.select("key", "value", *([] if topic else ["topic"]), *(["headers"] if "headers" in df.columns else [])).write.format("kafka") \
            .option("kafka.bootstrap.servers", bootstrap)
        if topic:
            w = w.option("topic", topic)
        w.save()
        return
    out = df if "topic" in df.columns else df.withColumn("topic", F.lit(topic))
    cols = [c.split()[0] for c in ENVELOPE_SCHEMA.split(", ")] + (["headers"] if "headers" in out.columns else [])
    out.select(*cols).write.mode(mode).parquet(path)
