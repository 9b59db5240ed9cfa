"""Positions inside groups, ordered string aggregation and wide slots.

A group may hold a large share of all rows, so nothing here gathers a whole group:
 * capped forms filter on the bare rank, which Spark turns into a per-task limit before the shuffle;
 * uncapped forms count per (group, coarse step of the order) first, and window only inside a step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import clip


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cap: int,
                   name: str = "rn") -> DataFrame:
    """The first `cap` rows of each group with their 1-based position."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= cap)


def joined(position: str, value: Column, sep: str, width: int | None = None) -> Column:
    """Aggregate: the values in the order of `position`, nulls left out."""
    items = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), value.alias("v"))))
    return clip(F.array_join(F.transform(items, lambda x: x["v"]), sep), width)


def ordered_concat(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column | str,
                   sep: str, cap: int, width: int | None = None, name: str = "joined") -> DataFrame:
    """One string per group: at most `cap` values in order, cut to `width` characters.

    The cap is part of the result (the columns of the reports have a fixed size); it also bounds
    every list. No group is dropped.
    """
    v = F.col(value) if isinstance(value, str) else value
    ranked = first_in_group(df.withColumn("_v", v), keys, order, cap)
    return ranked.groupBy(*keys).agg(joined("rn", F.col("_v"), sep, width).alias(name))


def padded_concat(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column | str,
                  sep: str, cap: int, name: str = "joined") -> DataFrame:
    """As ordered_concat, but empty places keep their separator (trailing blanks)."""
    v = F.col(value) if isinstance(value, str) else value
    ranked = first_in_group(df.withColumn("_v", v), keys, order, cap)
    places = [F.coalesce(F.max(F.when(F.col("rn") == i, F.col("_v"))), F.lit("")) for i in range(1, cap + 1)]
    return ranked.groupBy(*keys).agg(F.concat_ws(sep, *places).alias(name))


def placed_concat(df: DataFrame, keys: Sequence[str], place: str, value: Column | str, sep: str, places: int, name: str = "joined") -> DataFrame:
    """One string per group with each value at its stored place (1 to `places`).

    A place without a value keeps its separator; of several values at one place the greatest stays. Values stored at other places are
    not shown; `numbered` lists them. Aggregates combine before the shuffle, so no group is gathered.
    """
    v = F.col(value) if isinstance(value, str) else value
    at = [F.coalesce(F.max(F.when(F.col(place) == i, v)), F.lit("")) for i in range(1, places + 1)]
    return df.groupBy(*keys).agg(F.concat_ws(sep, *at).alias(name))


def slots(df: DataFrame, keys: Sequence[str], order: Sequence[Column], fields: dict[str, Column | str],
          count: int, first: int = 0, pattern: str = "{field}{i}") -> DataFrame:
    """The first `count` rows of a group side by side.

    Every group is cut to `count` rows before they are gathered, and gathered as one short array:
    a single aggregate per row instead of one per output column.
    """
    picked = F.struct(F.col("rn"), *[(F.col(x) if isinstance(x, str) else x).alias(f) for f, x in fields.items()])
    ranked = first_in_group(df, keys, order, count)
    wide = ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(picked)).alias("_items"))
    return wide.select(*keys, *[
        F.get("_items", F.lit(i))[f].alias(pattern.format(field=f, i=i + first)) for i in range(count) for f in fields])


def numbered(df: DataFrame, keys: Sequence[str], items: Sequence[str], coarse: Column) -> DataFrame:
    """All rows of every group with their position: keys, position, items.

    Rows are ordered by the items, nulls first; equal rows follow one another. Nothing is cut, and no task holds a whole group: positions are
    counted per coarse step of the order (`coarse` must grow with the first item).
    """
    rows = df.select(*keys, F.struct(*items).alias("_item"), coarse.alias("_coarse"))
    placed = cumulative(rows, keys, "_item", F.col("_coarse"))
    position = F.explode(F.sequence(F.col("n_lt") + 1, F.col("n_le")))
    return placed.select(*keys, "_item", position.alias("position")).select(*keys, "position", "_item.*")


def chunked(numbered_rows: DataFrame, keys: Sequence[str], value: Column, sep: str, size: int = 1000) -> DataFrame:
    """Complete strings as numbered chunks: keys, chunk, joined (at most `size` values each), from the rows of `numbered`."""
    rows = numbered_rows.withColumn("chunk", F.floor((F.col("position") - 1) / size)).withColumn("_v", value)
    return rows.groupBy(*keys, "chunk").agg(joined("position", F.col("_v"), sep).alias("joined"))


def cumulative(df: DataFrame, keys: Sequence[str], order: str, coarse: Column) -> DataFrame:
    """Per (group, value of `order`): n, and how many rows of the group are `<=` and `<` that value.

    `coarse` must grow with `order` (a prefix, a month, a quotient). Rows are counted per value,
    then per coarse step; a group is never sorted as a whole, only its list of steps and the
    values inside one step.
    """
    keys = list(keys)
    per_value = (df.groupBy(*keys, coarse.alias("_step"), F.col(order).alias(order))
                 .agg(F.count(F.lit(1)).alias("n")))
    steps = per_value.groupBy(*keys, "_step").agg(F.sum("n").alias("_in_step"))
    before = Window.partitionBy(*keys).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select(*keys, "_step", F.coalesce(F.sum("_in_step").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_step").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (per_value.withColumn("_run", F.sum("n").over(inside))
            .join(steps, [*keys, "_step"])
            .select(*keys, order, "n", (F.col("_before") + F.col("_run")).alias("n_le"),
                    (F.col("_before") + F.col("_run") - F.col("n")).alias("n_lt")))


def previous_value(df: DataFrame, keys: Sequence[str], coarse: Column, order: Sequence[str],
                   value: str, name: str) -> DataFrame:
    """lag(value) within the group, windowing only inside a coarse step of the order.

    The first row of a step takes the last value of the step before it.
    """
    keys = list(keys)
    stepped = df.withColumn("_step", coarse)
    last = stepped.groupBy(*keys, "_step").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    last = last.select(*keys, "_step",
                       F.lag("_last").over(Window.partitionBy(*keys).orderBy("_step")).alias("_carry"))
    w = Window.partitionBy(*keys, "_step").orderBy(*order)
    return (stepped.withColumn("_rn", F.row_number().over(w))
            .withColumn("_lag", F.lag(value).over(w))
            .join(last, [*keys, "_step"])
            .withColumn(name, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag")))
            .drop("_step", "_rn", "_lag", "_carry"))


LEVELS = (8, 14)  # 256 to 16,384 steps: what bounds the rows of every unpartitioned window and broadcast below


def step_levels(partitions: int) -> int:
    """Halvings of the key range, four steps for each shuffle partition the data asks for."""
    return min(max(LEVELS[0], (4 * partitions - 1).bit_length()), LEVELS[1])


def _partitions(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    return int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))


def _step_of(df: DataFrame, key: str, cuts: Column, levels: int) -> DataFrame:
    """Add `_step`, how many of the cuts are below the key, by binary search."""
    df = df.withColumn("_cuts", cuts).withColumn("_step", F.lit(0))
    for level in reversed(range(levels)):
        half = 2 ** level
        df = df.withColumn("_step", F.col("_step") + F.when(
            F.get("_cuts", F.col("_step") + (half - 1)) < F.col(key), half).otherwise(0))
    return df.drop("_cuts")


def running_number(df: DataFrame, key: str, amounts: dict[str, Column]) -> DataFrame:
    """Running totals over the groups in the order of the numeric `key`; amounts are aggregates.

    Groups are reduced to one row per key, keys are put into ranges by approximate quantiles, more of them
    the more partitions the data has, and only the totals of the ranges are added up in one place.
    """
    names = list(amounts)
    levels = step_levels(_partitions(df))
    steps = 2 ** levels
    per_key = df.groupBy(F.col(key).alias("_k")).agg(*[a.alias(n) for n, a in amounts.items()])
    cuts = per_key.agg(F.percentile_approx("_k", [i / steps for i in range(1, steps)], 10 * steps)).scalar()
    ranged = _step_of(per_key, "_k", cuts, levels)
    totals = ranged.groupBy("_step").agg(*[F.sum(n).alias(n) for n in names])
    before = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_step", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names])
    inside = Window.partitionBy("_step").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    numbered = (ranged.select("_k", "_step", *[F.sum(n).over(inside).alias(f"_run_{n}") for n in names])
                .join(F.broadcast(totals), "_step")  # one row per step
                .select("_k", *[(F.col(f"_before_{n}") + F.col(f"_run_{n}")).alias(n) for n in names]))
    return df.join(numbered, df[key] == numbered["_k"]).drop("_k")
