"""Dashboard pivots: grouped totals with subtotals, dimensions across as fixed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "Total"


def totalled(df: DataFrame, dims: Sequence[str], *aggs: Column) -> DataFrame:
    """Group by the dimensions with subtotals; a dimension rolled up shows as `Total`."""
    rolled = df.rollup(*dims).agg(*aggs, *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    names = [a for a in rolled.columns if a not in dims and not a.startswith("_g_")]
    return rolled.select(
        *[F.when(F.col(f"_g_{d}") == 1, F.lit(TOTAL)).otherwise(F.col(d).cast("string")).alias(d) for d in dims], *names)


def across(df: DataFrame, dims: Sequence[str], by: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """Counts of each value of `by` as its own column, plus `n`, with subtotals over the dimensions.

    The values are given, so no job runs to find them, and one aggregate fills all columns.
    """
    counts = [F.count_if(F.col(by) == v).alias(f"{prefix}{v}") for v in values]
    return totalled(df, dims, *counts, F.count(F.lit(1)).alias("n"))
