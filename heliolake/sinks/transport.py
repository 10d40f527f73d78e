"""Per-record delivery: HTTP POST by key, MQTT publish to ``root/key``, spreadsheet rows, and
a custom batch-sink template. Shaping (url/topic/body) is Spark columns; only the final send
is Python, one client per partition task, with ``delivery.deliver`` around each chunk."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.functions.text import data_path, topic_path
from heliolake.streaming.delivery import Backpressure, DeliveryPolicy, send_partitions


def http_requests(df: DataFrame, base_url: str, key_col: str = "location_id",
                  body_cols: Sequence[str] | None = None, body_col: str | None = None) -> DataFrame:
    """K8 shaping: ``(url, body)`` — path ``base/data/{key}`` or ``base/data/`` when the key is
    empty; the body is the record as JSON (``body_col`` passes an existing JSON text)."""
    body = F.col(body_col) if body_col else F.to_json(F.struct(*(body_cols or df.columns)))
    return df.select(data_path(base_url, F.col(key_col)).alias("url"), body.alias("body"))


def mqtt_messages(envelope: DataFrame, root: str) -> DataFrame:
    """K9 shaping: ``(topic, payload, _reject)`` from the message key; a NULL or non-UTF-8 key
    is a rejected row instead of a crash."""
    t = topic_path(root, F.col("key"))
    return envelope.select(t.alias("topic"), F.col("value").cast("string").alias("payload"),
                           F.when(t.isNull(), F.lit("bad_key")).alias("_reject"))


class HttpSender:
    """POST each ``(url, body)`` with a timeout; non-2xx or I/O errors -> ConnectionError,
    429/503 -> Backpressure. Uses only the standard library."""

    def __init__(self, timeout_s: float = 10.0, headers: dict | None = None):
        self.timeout_s = timeout_s
        self.headers = {"Content-Type": "application/json", **(headers or {})}

    def __call__(self, records: list) -> None:
        import urllib.error
        import urllib.request
        for url, body in records:
            req = urllib.request.Request(url, data=body.encode("utf-8"), headers=self.headers, method="POST")
            try:
                with urllib.request.urlopen(req, timeout=self.timeout_s) as resp:
                    if not 200 <= resp.status < 300:
                        raise ConnectionError(f"HTTP {resp.status} for {url}")
            except urllib.error.HTTPError as e:
                if e.code in (429, 503):
                    raise Backpressure(30.0, f"HTTP {e.code}") from e
                raise ConnectionError(f"HTTP {e.code} for {url}") from e
            except (urllib.error.URLError, TimeoutError, OSError) as e:
                raise ConnectionError(str(e)) from e


def post_records(df: DataFrame, base_url: str, key_col: str = "location_id",
                 make_sender: Callable[[], Callable[[list], None]] | None = None,
                 policy: DeliveryPolicy = DeliveryPolicy(), chunk_size: int = 1000) -> None:
    """K8: shape and POST every row (10 s timeout, 3 tries 3 s apart by default)."""
    req = http_requests(df, base_url, key_col)
    send_partitions(req, make_sender or (lambda: HttpSender()), ["url", "body"], policy, chunk_size)


def publish_records(envelope: DataFrame, root: str, make_sender: Callable[[], Callable[[list], None]],
                    policy: DeliveryPolicy = DeliveryPolicy(attempts=1), chunk_size: int = 1000) -> DataFrame:
    """K9: publish good rows to ``root/key``; returns the rejected rows (bad keys)."""
    msgs = mqtt_messages(envelope, root)
    send_partitions(msgs.filter(F.col("_reject").isNull()), make_sender, ["topic", "payload"], policy, chunk_size)
    return msgs.filter(F.col("_reject").isNotNull())


class BatchSink:
    """K11/X4 template: subclass and implement ``write(batch_df, batch_id)``; ``setup`` runs
    once before the first batch, ``close`` on stop. Use ``as_batch_fn`` with foreachBatch."""

    def __init__(self):
        self._ready = False

    def setup(self) -> None:  # create tables, clients on the driver side
        pass

    def write(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass

    def as_batch_fn(self):
        def run(batch: DataFrame, batch_id: int) -> None:
            if not self._ready:
                self.setup()
                self._ready = True
            self.write(batch, batch_id)
        return run


def sheet_rows_sink(path: str, order_by: Sequence[str] = ()):
    """K7: spreadsheet-like append: CSV rows in layout order; the header goes in only while the sheet is empty.

    The header is a row of its own folder (``header``), written by the first batch that brings rows; each batch has
    its folder, so a replay rewrites only its rows. :func:`read_sheet` gives the sheet as it would be shown.
    """
    root = path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/header")
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) and not batch.isEmpty():
            spark.createDataFrame([tuple(batch.columns)], ", ".join(f"c{i} string" for i in range(len(batch.columns)))).coalesce(1).write.csv(f"{root}/header")
        rows = batch.sortWithinPartitions(*order_by) if order_by else batch
        rows.write.mode("overwrite").option("header", "false").option("emptyValue", "").csv(f"{root}/rows/batch={int(batch_id):012d}")
    return run


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The sheet's rows as text columns named by its header, with their batch."""
    root = path.rstrip("/")
    header = list(spark.read.csv(f"{root}/header").first())
    schema = ", ".join(f"`{c}` string" for c in header)
    return spark.read.schema(f"{schema}, batch long").option("header", "false").csv(f"{root}/rows")
