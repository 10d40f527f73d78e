"""Table sinks: create-if-absent DDL, append with time layout, keyed upsert, window state.

Keyed tables need no transactional format. Rows are stored in *generations* of hash buckets
(``_gen=<n>-<writer>/_bucket=<b>``). A micro-batch, combined per key, becomes one small generation; after
``compact_every`` of them the touched buckets alone are merged with their base into a new one. A commit
is a new pointer file, created once and never changed, that names the live generation of every bucket; readers
take the newest pointer, so they see a whole commit or none. A read therefore looks at the base
and a bounded number of batches, however many came before. A replayed batch id changes nothing.

Where a relational database is the target, :func:`upsert_statement` + :func:`write_jdbc_partitions`
send ``INSERT .. ON CONFLICT`` per partition instead.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructType,
                               TimestampNTZType, TimestampType)

from heliolake.operators.latest import latest_per_key
from heliolake.operators.windows import last_order

BATCH_COL = "_batch"


def append_table(df: DataFrame, path: str, *, time_col: str | None = None, sort_by: Sequence[str] = (),
                 date_col: str = "event_date", mode: str = "append") -> None:
    """K4 + O1/O2: append rows, partitioned by day of ``time_col`` and sorted by ``sort_by``.

    ``rebalance`` by day lets AQE size the write tasks from the measured shuffle: a hot day is
    split over several tasks and small days are merged, without a sampling pass over the input
    (range partitioning would compute the whole upstream twice). Files are sorted by
    (day, sort key), so parquet min/max statistics let time and key filters skip row groups.
    """
    out = df
    parts: list[str] = []
    if time_col:
        out = out.withColumn(date_col, F.to_date(F.col(time_col)))
        parts = [date_col]
    out = out.hint("rebalance", *parts) if parts else out.hint("rebalance")
    keys = [*parts, *sort_by]
    if keys:
        out = out.sortWithinPartitions(*keys)
    w = out.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


class _Pointers:
    """The commits of a table: ``_commits/<number>.json``, each written once.

    A commit renames a draft of the writer's own to the next number, which fails if that number exists. The rename is atomic on
    HDFS and stores with atomic rename; on others, as on a local disk, a table must have one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._p = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._p(path).getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        folder = self._p(f"{self.path}/_commits")
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def state(self, number: int) -> dict:
        stream = self._fs.open(self._p(f"{self.path}/_commits/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self) -> dict:
        numbers = self.numbers()
        if not numbers:
            return {"number": 0, "next_gen": 0, "buckets": None, "base": {}, "batches": {}, "merged_through": None, "meta": {}}
        return self.state(numbers[-1])

    def commit(self, state: dict) -> None:
        """Fails if another writer has committed this number."""
        state["number"] += 1
        target = self._p(f"{self.path}/_commits/{state['number']:012d}.json")
        draft = self._p(f"{self.path}/_commits/.{state['number']:012d}.{uuid.uuid4().hex}.draft")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        files = self.spark._jvm.org.apache.hadoop.fs
        plain = self.spark.sparkContext._gateway.new_array(files.Options.Rename, 0)
        try:
            files.FileContext.getFileContext(target.toUri(), self._conf).rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), plain)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            raise RuntimeError(f"another writer committed {target}") from e

    def sizes(self, gen: str) -> dict[int, int]:
        """Bytes of every bucket of a generation; one entry a bucket."""
        folder, found = self._p(f"{self.path}/_gen={gen}"), {}
        files = self._fs.listFiles(folder, True) if self._fs.exists(folder) else None
        while files is not None and files.hasNext():
            f = files.next()
            parent = f.getPath().getParent().getName()
            if parent.startswith("_bucket="):
                found[int(parent[8:])] = found.get(int(parent[8:]), 0) + f.getLen()
        return found

    def remove_dead(self, keep: int) -> int:
        """Remove all but the newest ``keep`` commits and the generations that none of these names.

        A generation numbered from the oldest kept commit on may belong to a writer that has not committed yet; it stays.
        """
        numbers = self.numbers()
        kept = [self.state(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self._fs.delete(self._p(f"{self.path}/_commits/{n:012d}.json"), False)
        named = {gen for s in kept for gen in (*s["batches"].values(), *(gen for gen, _ in s["base"].values()))}
        removed = 0
        for f in self._fs.listStatus(self._p(self.path)):
            name = f.getPath().getName()
            if name.startswith("_gen=") and name[5:] not in named and int(name[5:].split("-")[0]) < kept[0]["next_gen"]:
                self._fs.delete(f.getPath(), True)
                removed += 1
        return removed


def _parent(bucket: int, buckets: int, first: int) -> int:
    """The bucket among ``buckets`` that was split, perhaps more than once, to give ``bucket``."""
    while bucket >= buckets:
        low = first
        while low * 2 <= bucket:
            low *= 2
        bucket -= low
    return bucket


class KeyedTable:
    """Keyed table by generations of hash buckets (K3 upsert, T12 idempotent replay).

    ``combine`` reduces rows of equal keys (default: the row with the greatest ``order``); it must give the same
    result over parts combined before. ``batch_wins``: a later batch beats an earlier one, whatever ``order`` says.
    Rows with a NULL in a key cannot be upserted; they are written to ``rejects()`` with a reason.

    The table starts with ``buckets`` buckets and grows by linear hashing: a compaction measures the bytes of the base and splits as many
    buckets, in order, as keep the average below ``bucket_bytes``; the others keep their files. Commits beyond the
    newest ``keep_commits``, and generations that no kept commit names, are removed, so the files follow the live rows and not the batches;
    a DataFrame of :meth:`read` stays valid for that many commits.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], *, batch_wins: bool = True,
                 combine: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 8, compact_every: int = 8,
                 bucket_bytes: int = 128 << 20, keep_commits: int = 24, spark: SparkSession | None = None):
        self.path = path.rstrip("/")
        self.keys, self.order = list(keys), list(order)
        self.batch_wins = batch_wins and combine is None
        self._combine = combine or (lambda df: latest_per_key(df, self.keys, [*([BATCH_COL] if self.batch_wins else []), *self.order] or [BATCH_COL]))
        self.buckets, self.compact_every, self.bucket_bytes, self.keep_commits = buckets, compact_every, bucket_bytes, max(keep_commits, 1)
        self.spark = spark or SparkSession.getActiveSession()

    def _pointers(self) -> _Pointers:
        return _Pointers(self.spark, self.path)

    def upsert(self, batch: DataFrame, batch_id: int, meta: dict | None = None) -> None:
        """Write one batch, combined per key, and commit it; ``meta`` is kept with the commit."""
        pointers = self._pointers()
        state = pointers.newest()
        if state["merged_through"] is not None and batch_id <= state["merged_through"]:
            return                                        # a replay of a batch that is merged already
        null_key = F.lit(False)
        for k in self.keys:
            null_key = null_key | F.col(k).isNull()
        bad = batch.filter(null_key).withColumn("_reason", F.lit("null_key")).withColumn(BATCH_COL, F.lit(int(batch_id)))
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(f"{self.path}/_rejects"))
        rows = batch.filter(~null_key).withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
        state["buckets"] = state["buckets"] or [self.buckets, self.buckets]
        gen = self._write(self._combine(rows), state)
        state["batches"][str(int(batch_id))] = gen         # a replay replaces its own generation
        state["meta"] |= meta or {}
        pointers.commit(state)
        if len(state["batches"]) >= self.compact_every:
            self.compact()

    @staticmethod
    def _bucket(keys: Sequence[str], first: int, buckets: int):
        """Linear hashing: the hash modulo the next doubling of ``first``, or modulo the last one for buckets that are not split yet."""
        low = first
        while low * 2 <= buckets:
            low *= 2
        h = F.xxhash64(*keys)
        wide = F.pmod(h, F.lit(2 * low))
        return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(low))).cast("int")

    def _write(self, rows: DataFrame, state: dict) -> str:
        """A new generation, of a name of this writer's own; AQE sizes the tasks, so a large bucket is several files."""
        gen = f"{state['next_gen']:012d}-{uuid.uuid4().hex[:12]}"
        state["next_gen"] += 1
        (rows.withColumn("_bucket", self._bucket(self.keys, *state["buckets"])).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *self.keys)
         .write.partitionBy("_bucket").parquet(f"{self.path}/_gen={gen}"))
        return gen

    def _rows(self, gens: dict[str, list[int] | None]) -> DataFrame | None:
        """The rows of the given buckets (None: all) of each generation, read by partition folder."""
        parts = []
        for gen, buckets in gens.items():
            try:
                part = self.spark.read.parquet(f"{self.path}/_gen={gen}")
            except AnalysisException as e:
                if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                    raise
                continue                                   # a generation without any row has no file
            parts.append(part if buckets is None else part.filter(F.col("_bucket").isin(buckets)))
        out = None
        for part in parts:
            out = part if out is None else out.unionByName(part)
        return out

    @staticmethod
    def _base(state: dict, wanted: Iterable[int] | None = None) -> dict[str, list[int]]:
        gens: dict[str, list[int]] = {}
        for bucket, (gen, size) in state["base"].items():
            if size and (wanted is None or int(bucket) in wanted):
                gens.setdefault(gen, []).append(int(bucket))
        return gens

    def _live(self, state: dict) -> dict[str, list[int] | None]:
        return self._base(state) | {gen: None for gen in state["batches"].values()}

    def compact(self) -> None:
        """Merge the batches into the base; only the buckets that they touch, and those that are split, are rewritten."""
        pointers = self._pointers()
        state = pointers.newest()
        if not state["batches"]:
            return
        first, old = state["buckets"]
        held = sum(size for _, size in state["base"].values()) + sum(sum(pointers.sizes(gen).values()) for gen in state["batches"].values())
        now = max(old, -(-held // self.bucket_bytes))
        batches = self._rows({gen: None for gen in state["batches"].values()})
        touched = set()
        if batches is not None:
            touched = {r[0] for r in batches.select(self._bucket(self.keys, first, old).alias("b")).distinct().collect()}      # bucket numbers
        children: dict[int, list[int]] = {}
        for b in range(now):
            children.setdefault(_parent(b, old, first), []).append(b)
        rewritten = {b for b in range(old) if b in touched or len(children[b]) > 1}
        before = self._rows(self._base(state, rewritten))
        state["buckets"] = [first, now]
        if batches is not None or before is not None:
            rows = [df for df in (before, batches) if df is not None]
            gen = self._write(self._combine((rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])).drop("_bucket")), state)
            sizes = pointers.sizes(gen)
            state["base"] |= {str(c): [gen, sizes.get(c, 0)] for b in rewritten for c in children[b]}
        state["merged_through"] = max(map(int, state["batches"]))
        state["batches"] = {}
        pointers.commit(state)
        pointers.remove_dead(self.keep_commits)

    def read(self) -> DataFrame:
        rows = self._rows(self._live(self._pointers().newest()))
        if rows is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        return self._combine(rows.drop("_bucket")).drop(BATCH_COL)

    def rejects(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/_rejects")

    def meta(self) -> dict:
        return self._pointers().newest()["meta"]

    def generations(self) -> int:
        """Generations that a read looks at: the base's and the batches not merged yet."""
        return len(self._live(self._pointers().newest()))

    def bucket_count(self) -> int:
        state = self._pointers().newest()
        return (state["buckets"] or [0, self.buckets])[1]


class WindowTable:
    """Tumbling-window ``last`` / ``mean`` kept as mergeable parts in a keyed table.

    Every batch adds its parts (sum and count, or the last value with its place), so rows may come in any
    order: the state equals the batch answer, late rows included. A row whose window had closed by the
    earlier batches (their newest event time less ``lateness_s``) is also listed in :meth:`late`, with its reason.
    """

    def __init__(self, path: str, every: str, fn: str, *, time_col: str, value_col: str, series: Sequence[str], lateness_s: int,
                 order_col: str | None = None, buckets: int = 8, compact_every: int = 8):
        if fn not in ("last", "mean"):
            raise ValueError("fn must be 'last' or 'mean'")
        self.path, self.every, self.fn, self.time_col, self.value_col = path.rstrip("/"), every, fn, time_col, value_col
        self.series, self.lateness_s, self.order_col = list(series), lateness_s, order_col
        self.table = KeyedTable(f"{self.path}/state", [*self.series, "_time"], [], combine=self._merge, buckets=buckets, compact_every=compact_every)

    def _merge(self, parts: DataFrame) -> DataFrame:
        keys = [F.col(k) for k in (*self.series, "_time")]
        if self.fn == "mean":
            parts_of = [F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")]
        else:
            parts_of = [F.max_by("_last", "_place").alias("_last"), F.max("_place").alias("_place")]
        return parts.groupBy(*keys).agg(*parts_of, F.max(BATCH_COL).alias(BATCH_COL))

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        t, v = F.col(self.time_col), F.col(self.value_col)
        rows = batch.filter(v.isNotNull() & t.isNotNull()).withColumn("_time", F.window(t, self.every)["end"])
        high = self.table.meta().get("high")
        newest = rows.agg(F.unix_micros(F.max(t.cast("timestamp"))).alias("m")).first()["m"]
        if high is not None:
            closed = F.timestamp_micros(F.lit(high - self.lateness_s * 1_000_000))
            late = rows.filter(F.col("_time").cast("timestamp") <= closed).withColumn("_reason", F.lit("window_closed"))
        else:
            late = rows.filter(F.lit(False)).withColumn("_reason", F.lit("window_closed"))
        append_batch(late, f"{self.path}/late", batch_id)
        parts = [v.cast("double").alias("_sum"), F.lit(1).cast("long").alias("_n")] if self.fn == "mean" else [
            v.alias("_last"), last_order(t, F.col(self.order_col) if self.order_col else None).alias("_place")]
        self.table.upsert(rows.select(*self.series, "_time", *parts), batch_id, {"high": max(x for x in (high, newest) if x is not None)} if newest is not None else None)

    def read(self) -> DataFrame:
        value = F.col("_sum") / F.col("_n") if self.fn == "mean" else F.col("_last")
        return self.table.read().select(*self.series, "_time", value.alias("_value"))

    def late(self) -> DataFrame:
        return self.table.spark.read.parquet(f"{self.path}/late")


def append_batch(batch: DataFrame, path: str, batch_id: int, *, time_col: str | None = None, sort_by: Sequence[str] = (),
                 date_col: str = "event_date") -> None:
    """K4 inside foreachBatch: append one micro-batch into its own ``_batch`` folder; a replay
    of the same batch id overwrites exactly that folder (idempotent append). ``time_col`` and
    ``sort_by`` lay it out like :func:`append_table`: by day and sorted (O1/O2)."""
    out = batch.withColumn(BATCH_COL, F.lit(int(batch_id)))
    parts = [BATCH_COL]
    if time_col:
        out = out.withColumn(date_col, F.to_date(F.col(time_col)))
        parts.append(date_col)
    if time_col or sort_by:
        out = out.hint("rebalance", *parts[1:]).sortWithinPartitions(*parts, *sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def batch_written(spark: SparkSession, path: str, batch_id: int | None = None) -> bool:
    """Whether :func:`append_batch` has written this batch (or any) to ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path if batch_id is None else f"{path}/{BATCH_COL}={int(batch_id)}")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# ---- relational targets ---------------------------------------------------------------------

_SQL_TYPES = {StringType: "TEXT", DoubleType: "DOUBLE PRECISION", IntegerType: "INTEGER", LongType: "BIGINT",
              BooleanType: "BOOLEAN", TimestampType: "TIMESTAMPTZ", TimestampNTZType: "TIMESTAMP"}


def create_table_ddl(table: str, schema: StructType, primary_key: Sequence[str] = ()) -> str:
    """K2: ``CREATE TABLE IF NOT EXISTS`` text from a StructType (run once, e.g. in setup)."""
    cols = []
    for f in schema.fields:
        t = _SQL_TYPES.get(type(f.dataType))
        if t is None:
            raise ValueError(f"no SQL type for {f.name}: {f.dataType}")
        nn = " NOT NULL" if f.name in primary_key else ""
        cols.append(f"{f.name} {t}{nn}")
    if primary_key:
        cols.append(f"PRIMARY KEY ({', '.join(primary_key)})")
    return f"CREATE TABLE IF NOT EXISTS {table} (\n    " + ",\n    ".join(cols) + "\n)"


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], placeholder: str = "?") -> str:
    """K3 (relational): ``INSERT .. ON CONFLICT (keys) DO UPDATE SET`` every non-key column."""
    cols = ", ".join(columns)
    vals = ", ".join([placeholder] * len(columns))
    sets = ",\n    ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (f"INSERT INTO {table} ({cols})\nVALUES ({vals})\n"
            f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET\n    {sets}")


def write_jdbc_partitions(df: DataFrame, connect: Callable[[], object], statement: str,
                          columns: Sequence[str], batch_size: int = 1000) -> None:
    """Send each partition with ``executemany`` in chunks, one connection per task.

    ``connect`` is a picklable zero-argument factory returning a DB-API connection. Rows must
    already be deduplicated per key (``latest_per_key``) — a statement may not touch the same
    key twice. Commit happens per partition; a failed task is retried by Spark and the upsert
    makes the retry idempotent.
    """
    cols = list(columns)

    def send(rows: Iterable) -> None:
        conn = connect()
        try:
            cur = conn.cursor()
            chunk = []
            for r in rows:
                chunk.append(tuple(r[c] for c in cols))
                if len(chunk) >= batch_size:
                    cur.executemany(statement, chunk)
                    chunk = []
            if chunk:
                cur.executemany(statement, chunk)
            conn.commit()
        finally:
            conn.close()

    df.select(*cols).foreachPartition(send)
