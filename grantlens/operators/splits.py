"""Award splits: which ones a tracker shows, and how they differ from their proposal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["prop_id", "budg_yr", "splt_id"]


SHAPES = [["prop_id"], ["prop_id", "budg_yr"], ["prop_id", "splt_id"], KEY]  # the columns that a pattern can fix


def matching(splits: DataFrame, patterns: DataFrame) -> DataFrame:
    """Splits named by pattern rows (prop_id, budg_yr, splt_id), each once; a null year or split means any."""
    return _marked(splits, patterns).filter("_named").drop("_named")


def without(splits: DataFrame, patterns: DataFrame) -> DataFrame:
    """Splits no pattern row names."""
    return _marked(splits, patterns).filter("NOT _named").drop("_named")


def _marked(splits: DataFrame, patterns: DataFrame) -> DataFrame:
    """Splits with `_named`, whether a pattern names them.

    Patterns are dealt by the columns that they fix: one equality join for each shape, with at most one match for each split. No pattern meets a
    split that it does not name, however many patterns or splits a proposal has.
    """
    named = F.lit(False)
    for i, shape in enumerate(SHAPES):
        fixed = F.lit(True)
        for k in KEY:
            fixed = fixed & (F.col(k).isNotNull() if k in shape else F.col(k).isNull())
        found = patterns.filter(fixed).select(*shape).distinct().withColumn(f"_shape{i}", F.lit(True))
        splits = splits.join(found, shape, "left")
        named = named | F.coalesce(F.col(f"_shape{i}"), F.lit(False))
    return splits.withColumn("_named", named).drop(*[f"_shape{i}" for i in range(len(SHAPES))])


def tracked(splits: DataFrame, chosen: Column, include: DataFrame, omit: DataFrame) -> DataFrame:
    """Splits chosen by criteria or by the include list, each once, without the omitted ones."""
    listed = matching(splits.filter(~F.coalesce(chosen, F.lit(False))), include)
    return without(splits.filter(chosen).unionByName(listed), omit)
