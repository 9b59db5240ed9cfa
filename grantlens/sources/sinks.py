"""Result tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """A fresh folder for this application below the shared one that spark.checkpoint.dir names.

    Where that is unset it is the warehouse, if a cluster shares it; never a folder of one machine.
    """
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete what this application staged, wherever the shared folder is."""
    remove(spark, _application_folder(spark))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this application made, wherever it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _application_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or _in_warehouse(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)
    return f"{base.rstrip('/')}/grantlens/{spark.sparkContext.applicationId}"


def state(spark: SparkSession, folder: str) -> tuple[int, int, int] | None:
    """Bytes, files and last change of a table's folder (or file), from its listing; null where there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    listed = files.listStatus(path)
    return sum(f.getLen() for f in listed), len(listed), max((f.getModificationTime() for f in listed), default=0)


def _in_warehouse(warehouse: str, master: str) -> str:
    if not master.startswith("local") and ("://" not in warehouse or warehouse.startswith("file:")):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir: the warehouse is a folder of one machine")
    return f"{warehouse}/_work"


def save_result(df: DataFrame, path: str) -> dict[str, object]:
    """Write a report; rows are counted by the write itself, not by a second run."""
    seen = Observation()
    start = time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("error").parquet(path)
    return {"path": path, "n_rows": seen.get["n_rows"], "seconds": time.perf_counter() - start}


def staged(df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """Write a frame that several branches of one report read, and read it back.

    The table lies in the shared folder, so a lost executor does not lose it, the branches read
    only the columns they need, and nothing before it runs twice. Settings hold for the write alone.
    """
    spark = df.sparkSession
    path = work_folder(spark)
    before = {key: spark.conf.get(key) for key in settings or {}}
    try:
        for key, value in (settings or {}).items():
            spark.conf.set(key, value)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def large_selection(df: DataFrame, limit: int = 300) -> DataFrame:
    """How many rows a selection would pull, and whether to warn first."""
    return df.agg(F.count(F.lit(1)).alias("num_retrieved")).withColumn(
        "warn", F.when(F.col("num_retrieved") > limit, 1).otherwise(0))
