"""Restrictions on a parent by its child rows (codes, routing, addresses)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import criteria


def any_child(parent: DataFrame, child: DataFrame, matching: Column, key: str = "prop_id") -> DataFrame:
    """Parents with at least one child that matches."""
    return parent.join(child.filter(matching).select(key), key, "left_semi")


def no_child(parent: DataFrame, child: DataFrame, matching: Column, key: str = "prop_id") -> DataFrame:
    """Parents without any child that matches (also those without children)."""
    return parent.join(child.filter(matching).select(key), key, "left_anti")


def other_child(parent: DataFrame, child: DataFrame, matching: Column, key: str = "prop_id") -> DataFrame:
    """Parents with some child that does not match: what a plain NOT over the join selects."""
    return parent.join(child.filter(~matching).select(key), key, "left_semi")


def by_codes(parent: DataFrame, child: DataFrame, col: str, spec: str, key: str = "prop_id") -> DataFrame:
    """A specification on child codes: listed ones wanted, or with ~ none of them allowed."""
    negated, text = criteria.split_negation(spec)
    if text == "":
        return parent
    cond = criteria.positive(child[col], text)
    return no_child(parent, child, cond, key) if negated else any_child(parent, child, cond, key)


def by_dimension(fact: DataFrame, dim: DataFrame, key: str, col: str, spec: str | None) -> DataFrame:
    """Restrict by a column of a dimension; it is joined only when the specification restricts."""
    cond = criteria.predicate(dim[col], spec)
    return fact if cond is None else fact.join(dim.filter(cond).select(key), key, "left_semi")


def holds(child: DataFrame, key: str, code: str, wanted: dict[str, str]) -> DataFrame:
    """Per parent and wanted code: is it among the children, however many there are?"""
    return child.groupBy(key).agg(*[F.max(F.rtrim(code) == value).alias(name) for name, value in wanted.items()])


_BAG = "struct<n:bigint,total:decimal(38,0),mix:bigint>"


def empty_bag() -> Column:
    return F.expr(f"cast(named_struct('n', 0, 'total', 0, 'mix', 0) AS {_BAG})")


def bag(child: DataFrame, keys: list[str], value: Column, name: str, distinct: bool = False) -> DataFrame:
    """Per parent one value that is equal for equal children, in whatever order: their number and two sums of 64-bit hashes.

    All parts are combined before the shuffle, so a parent with very many children costs no list.
    """
    rows = child.select(*keys, value.alias("_v"))
    rows = rows.distinct() if distinct else rows
    first, second = F.xxhash64("_v"), F.xxhash64(F.lit(1), F.col("_v"))
    return rows.groupBy(*keys).agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(first.cast("decimal(28,0)")).alias("total"), F.bit_xor(second).alias("mix")).cast(_BAG).alias(name))
