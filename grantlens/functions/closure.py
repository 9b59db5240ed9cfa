"""What links reach: the closure of a table of links, by repeated doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import staged


def closure(links: DataFrame) -> DataFrame:
    """node, reached, hops: everything that can be reached over links (node, reached), with the fewest steps.

    Each round joins what is known with itself, so chains of n links need about log2(n) rounds. A round is written to the shared folder and
    read back: the plan stays short, no executor's loss undoes it, and a node with very many links is split by the join.
    Rounds end when they add nothing and shorten nothing, so cycles end as well; a node that reaches itself is left out.
    """
    known = staged(links.where("node != reached").select("node", "reached").distinct().withColumn("hops", F.lit(1).cast("long")))
    before = _size(known)
    while before[0]:
        further = known.select(F.col("reached").alias("_via"), F.col("node").alias("_from"), F.col("hops").alias("_n")).join(
            known.withColumnRenamed("node", "_via"), "_via").where("_from != reached")
        both = known.unionByName(further.select(F.col("_from").alias("node"), "reached", (F.col("_n") + F.col("hops")).alias("hops")))
        known = staged(both.groupBy("node", "reached").agg(F.min("hops").alias("hops")))
        after = _size(known)
        if after == before:
            break
        before = after
    return known


def _size(known: DataFrame) -> tuple:
    """Pairs, and their steps in all."""
    return tuple(known.agg(F.count(F.lit(1)), F.sum("hops")).first())
