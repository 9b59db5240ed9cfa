"""Session settings the library relies on, and a session for local runs."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Runtime settings only: they can be changed on a session somebody else created.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A lead, reviewer or panel may own a large share of the rows. Splitting a skewed join
    # partition is worth an extra shuffle of the (smaller) join result, hence "force".
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled rows are compressed, and take up to 80 times as much while they are joined, sorted and grouped:
    # what adaptive execution merges, and when it splits, has to be small for a task's memory to be.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
}


PARTITION_BYTES = 1 << 30  # of rows, per initial shuffle partition
ROWS_PER_FILE = 128  # bytes that rows take while they are joined, sorted and grouped, for a byte of their compressed column files
SCAN_BYTES = 8 << 20, 128 << 20  # of column files in a task that reads them, least and most
MOST_PARTITIONS = 32_768  # map outputs times this many blocks is what the driver keeps track of


def initial_partitions(read_bytes: int, asked: int) -> int:
    """Shuffle partitions to start with, for a query over so many bytes of rows; adaptive execution joins small ones."""
    return max(asked, min(-(-read_bytes // PARTITION_BYTES), MOST_PARTITIONS))


def scan_bytes(read_bytes: int) -> int:
    """Bytes of column files in a task of a query that reads so many: a fixed share, as rows are grouped in the task that reads them; larger only for too many tasks."""
    least, most = SCAN_BYTES
    return max(least, min(read_bytes // MOST_PARTITIONS, most))


def isolated(spark: SparkSession) -> SparkSession:
    """A session of its own for one query, with the caller's settings and the adaptive ones above; the caller's stays as it is."""
    own = spark.newSession()
    has = _settings(own)
    for key, value in {**_settings(spark), **RUNTIME}.items():
        if key.startswith("spark.sql.") and has.get(key) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def _settings(spark: SparkSession) -> dict[str, str]:
    """What is set in a session, in one answer."""
    return {r["key"]: r["value"] for r in spark.sql("SET").collect()}


def expect(spark: SparkSession, read_bytes: int) -> None:
    """Cut this session's scans, and start its shuffles with partitions, for the rows in what its query reads, so that a task's share does not grow with the tables."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(scan_bytes(read_bytes)))
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions(read_bytes * ROWS_PER_FILE, asked)))


def local_session(cores: int | str = 8, app: str = "grantlens") -> SparkSession:
    """A session for tests and benchmarks on one machine, with a shared folder of its own."""
    shared = tempfile.mkdtemp(prefix=f"{app}-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("GRANTLENS_DRIVER_MEMORY", "12g"))
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=768m -XX:+UseParallelGC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # wide reports have many stages
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark
