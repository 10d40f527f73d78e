"""Session helpers: one place for the engine settings the library relies on."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. They are applied only when the session does
# not already carry a value, so a cluster's own configuration always wins.
ENGINE_DEFAULTS = {
    # event times are UTC instants; pin the session zone so ns/ms epochs map 1:1
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce tiny shuffle partitions, split skewed join partitions and
    # turn a sort-merge join into a broadcast join only when the *measured* side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide decode projections can generate a processNext() above the JVM's 8000-byte JIT limit;
    # past that size fall back to split (per-expression) codegen instead of running
    # uncompiled bytecode
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "heliolake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults; used by tests and bench."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply ENGINE_DEFAULTS to a running session where the key is unset."""
    for k, v in ENGINE_DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    # the zone must be UTC for epoch conversions to be exact
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once a context: executors need neither an install nor a path to it.

    The modules go as a zip into the shared folder, which Spark hands to every worker.
    """
    sc = spark.sparkContext
    if getattr(sc, "_heliolake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):         # else the package itself is already run from a zip
        found = sorted(os.path.join(d, f) for d, _, files in os.walk(here) for f in files if f.endswith(".py"))
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for f in found:
                with open(f, "rb") as module:
                    z.writestr(zipfile.ZipInfo(os.path.join("heliolake", os.path.relpath(f, here))), module.read())
        path = shared_dir(spark, "package", uuid.uuid4().hex, f"heliolake-{hashlib.sha256(buffer.getvalue()).hexdigest()[:16]}.zip")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(buffer.getvalue()))
        finally:
            out.close()
        sc.addPyFile(path)
    sc._heliolake_shipped = True


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the cluster's shared storage for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). A cluster must name one: executors
    would write to different disks otherwise, so an unset folder raises. Only a local master, whose executors are the
    driver, gets a temporary folder of its own (tests, bench).
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="heliolake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


_made: list[str] = []


def unique_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused sub-folder of ``shared_dir`` (one per run)."""
    path = shared_dir(spark, *parts, uuid.uuid4().hex)
    _made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the folders that ``unique_dir`` has given out in this process; call it when their
    results have been read. Returns how many there were."""
    n = len(_made)
    while _made:
        p = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def cpu_count() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
