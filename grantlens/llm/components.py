"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discarded, stored


def connected(edges: DataFrame) -> DataFrame:
    """node, part of every node of the edges (a, b): the smallest node that it is connected with.

    Alternating large and small stars: every node's larger neighbours, then its smaller ones, are tied to its smallest neighbour, until
    each part is one star. Each round is stored in the shared folder, and so are the minima, so that joins read both sides from a shuffle
    and a node that many edges share is split. An empty table of edges has no nodes.
    """
    pairs = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = _summary(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = stored(both.join(least, "a").where("b > a AND m != b").select(F.col("m").alias("a"), "b"))
        # Here every edge goes up from a to b: b is tied to the smallest of its smaller neighbours, and so are they.
        lowest = stored(large.groupBy("b").agg(F.min("a").alias("m")))
        small = large.join(lowest, "b").select("m", F.explode(F.array("a", "b")).alias("b")).where("m != b")
        old, pairs = pairs, stored(small.select(F.col("m").alias("a"), "b").distinct())
        discarded(least, large, lowest, old)
        after = _summary(pairs)
        if after == before:
            break
        before = after
    stars = pairs.select(F.col("b").alias("node"), F.col("a").alias("part"))
    return stars.unionByName(pairs.select(F.col("a").alias("node"), F.col("a").alias("part")).distinct())


def _summary(pairs: DataFrame) -> tuple:
    """Number of edges and two sums of their hashes: equal for equal sets of edges."""
    first, second = F.xxhash64("a", "b"), F.xxhash64("b", "a")
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(first.cast("decimal(28,0)")), F.bit_xor(second)).first())
