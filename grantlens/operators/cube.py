"""One cube for all pivots of a workbook: proposals counted and summed once over every dimension that pivots and filters use.

The cube holds partial aggregates that can be merged (counts, exact sums, extremes), so any pivot, filter or subtotal is an aggregate of
its rows. Its size follows the combinations of codes, not the proposals. It is written to the shared folder once per
application and tables, and refreshed when a table's files change.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import sinks

DIMENSIONS = ["Dir", "Div", "org_code", "pgm_ele_code", "natr_rqst_code", "prop_stts_code", "ILN", "obj_clas_code", "PO"]
TICKS = 10_000  # money is summed in ten-thousandths, as whole numbers

_BUILT: dict[tuple, tuple[StructType, str]] = {}  # what is stored where


def build(base: DataFrame, dimensions: Sequence[str] = DIMENSIONS, money: str = "rqst_dol") -> DataFrame:
    """dimensions, n, n_dol, ticks, low, high: one row for each combination that occurs."""
    return base.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("n"), F.count(money).alias("n_dol"), F.sum(ticks(money)).alias("ticks"), F.min(money).alias("low"), F.max(money).alias("high"))


def ticks(money: Column | str) -> Column:
    col = F.col(money) if isinstance(money, str) else money
    return (col.cast("decimal(18,4)") * TICKS).cast("long")


def kept(spark: SparkSession, folder: str, tables: Sequence[str], make: Callable[[], DataFrame]) -> DataFrame:
    """The cube of these tables: built and stored at the first call of an application, and again when their files have changed."""
    key = (spark.sparkContext.applicationId, folder, tuple(sinks.state(spark, f"{folder}/{t}.parquet") for t in tables))
    schema, path = _BUILT.get(key, (None, None))
    if path is None or sinks.state(spark, path) is None:
        made, path = make(), sinks.work_folder(spark)
        made.write.parquet(path)
        schema = made.schema
        _BUILT[key] = schema, path
    return spark.read.schema(schema).parquet(path)


def measures() -> dict[str, Column]:
    """Merged from the cube's rows: how many, least, average (half up, four places) and most money."""
    half_up = F.expr("(2 * sum(ticks) + cast(sign(sum(ticks)) AS bigint) * sum(n_dol)) div (2 * sum(n_dol))")
    average = F.when(F.sum("n_dol") > 0, half_up / TICKS)
    return {"n": F.sum("n"), "min_dol": F.round(F.min("low"), 2), "avg_dol": average, "max_dol": F.round(F.max("high"), 2)}
