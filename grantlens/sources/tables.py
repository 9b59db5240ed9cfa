"""Base tables, in two catalogs that reports join across."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import sinks

STAFF = ("region", "nation", "customer", "orders")
SUBMISSION = ("supplier", "part", "lineitem", "events", "documents", "embeddings", "pages",
              "benchmark", "labels", "conversations")
CATALOGS = {"staff": STAFF, "submission": SUBMISSION}

_SCHEMAS: dict[tuple, tuple[StructType, int]] = {}  # schema and bytes of a table's files as they were when last looked at


class Catalog:
    """Tables of a folder by name. A table's schema is read from a footer once per application and state of its files, and kept."""

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...] = (*STAFF, *SUBMISSION)):
        self.spark, self.folder, self.names = spark, folder, names

    def path(self, name: str) -> str:
        if name not in self.names:
            raise KeyError(f"{name} is not one of {', '.join(self.names)}")
        return f"{self.folder}/{name}.parquet"

    def _known(self, name: str) -> tuple[StructType, int]:
        path = self.path(name)
        files = sinks.state(self.spark, path)
        key = (self.spark.sparkContext.applicationId, path, files)
        if files is None or key not in _SCHEMAS:
            found = self.spark.read.parquet(path).schema, files[0]  # a missing table is Spark's own error
            _SCHEMAS[key] = found
        return _SCHEMAS[key]

    def schema(self, name: str) -> StructType:
        return self._known(name)[0]

    def size(self, name: str) -> int:
        """Bytes of the table's files."""
        return self._known(name)[1]

    def table(self, name: str, spark: SparkSession | None = None) -> DataFrame:
        """The table, planned without reading a footer. Another session's settings may be asked for."""
        return (spark or self.spark).read.schema(self.schema(name)).parquet(self.path(name))


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return Catalog(spark, folder).table(name)


def scan_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: scan(spark, folder, name) for name in (*STAFF, *SUBMISSION)}


def row_counts(catalog: Catalog) -> DataFrame:
    """table_name, n_rows of every table, from the files' footers: the count is pushed into the scan, so no column and no row is read."""
    footers = catalog.spark.newSession()
    listed = [x for x in footers.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    footers.conf.set("spark.sql.sources.useV1SourceList", ",".join(listed))
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = [catalog.table(name, footers).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name in catalog.names]
    return reduce(DataFrame.unionByName, parts)
