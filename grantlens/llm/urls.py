"""URL rules by a sort-merge range join.

Hosts are written with their labels in reverse and a dot after each, so that a rule's host is a prefix of the keys of all its
subdomains, and a prefix is an interval of the sorted keys. A sweep over sorted keys and rules keeps the stack of
rules whose intervals are open: rules are nested, so the stack is the last rule begun, with the rules around it, as far
as they still cover the key. One sweep finds the rule hosts around each host, a second one the longest path of
each such host. Only DataFrame functions are used.

Keys are cut into ranges at quantiles of (key, hash of the row), so that a key that many rows share is spread over several ranges;
the rule stack that is open where a range begins is carried into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii

RANGE_ROWS = 50_000  # keys in a range, on average
RANGES = (64, 65_536)
PER_RANGE = 24  # sampled keys from which a range's bounds are read
_MARK = "\u0001"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def nested(rules: DataFrame) -> DataFrame:
    """prefix, stack: each distinct prefix with all rules around it, outermost first, and itself. Columns: prefix, rest."""
    around = rules.select(F.col("prefix").alias("inner"), F.explode(F.expr("transform(sequence(1, length(prefix)), i -> substring(prefix, 1, i))")).alias("prefix"))
    held = around.join(rules, "prefix")
    return held.groupBy(F.col("inner").alias("prefix")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.length("prefix").alias("n"), "prefix", "rest"))), lambda s: s.dropFields("n")).alias("stack"))


def _range(key: Column, n: int, bounds: list[str]) -> Column:
    """How many bounds are at most the key, by halving."""
    if not bounds:
        return F.lit(0)
    listed = F.split(F.lit(_MARK.join(bounds)), _MARK)
    halves = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(listed, at + step - 1) <= key), at + step).otherwise(at))


def sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Add `active` to points (columns key, _row and others): the rules (prefix, rest) whose prefix begins the key, outermost first.

    Points are read more than once; rules have distinct prefixes.
    """
    total = points.count()
    ranges = min(max(RANGES[0], -(-total // RANGE_ROWS)), RANGES[1])
    spread = F.concat("key", F.lit("\u0000"), F.hex(F.xxhash64("key", "_row")))
    seen = points.select(spread.alias("k")).sample(min(1.0, PER_RANGE * ranges / max(total, 1)), 11)
    sample = sorted(r["k"].replace(_MARK, " ") for r in seen.collect())  # about PER_RANGE * ranges keys, only to place the bounds
    bounds = [b for b in sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if b] if sample else []
    stacks = nested(rules).withColumn("range", _range(F.col("prefix"), ranges, bounds))
    last = stacks.groupBy("range").agg(F.max_by("stack", "prefix").alias("stack"))
    every = points.sparkSession.range(len(bounds) + 1).select(F.col("id").cast("int").alias("range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over the ranges: RANGES[1] rows at most
    carried = every.join(last, "range", "left").select("range", F.last("stack", True).over(before).alias("stack"))
    begun = stacks.select("range", F.col("prefix").alias("key"), "stack", F.lit(1).alias("kind")).unionByName(
        carried.where("stack IS NOT NULL").select("range", F.lit("").alias("key"), "stack", F.lit(0).alias("kind")))
    rows = points.withColumn("range", _range(spread, ranges, bounds)).withColumn("kind", F.lit(2))
    order = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = rows.unionByName(begun, allowMissingColumns=True).withColumn("open", F.last("stack", True).over(order)).where("kind = 2")
    active = F.coalesce(F.filter("open", lambda r: F.startswith(F.col("key"), r["prefix"])), F.array())
    return swept.withColumn("active", active).drop("range", "kind", "stack", "open")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page; rules have host, path, verdict.

    A rule fits its host and all subdomains if the page's path starts with the rule's. The longest (host and path together, then
    host) wins; of two verdicts for one rule `block` does. Pages without a rule get the default. Each row is judged by itself,
    repeated rows too; rules with a null or empty host or a null path are no rules. Other columns are not read.
    """
    listed = rules.where("host != '' AND path IS NOT NULL").select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
    listed = listed.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = listed.select(host_key(F.col("host")).alias("node"), F.concat("host", "path").alias("rule"), "path", "verdict", F.length("host").alias("n"))
    hosts = keyed.select(F.col("node").alias("prefix"), F.lit(True).alias("rest")).distinct()
    paths = keyed.select(F.concat("node", F.lit("/"), "path").alias("prefix"), F.struct(F.length("rule").alias("length"), "n", "rule", "verdict").alias("rest"))
    host, path = parts(F.col("url"))
    points = pages.select(F.monotonically_increasing_id().alias("_row"), F.col("page_id"), F.col("url")).select(
        "_row", "page_id", host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    under = sweep(points, hosts).select("_row", "page_id", "host", "path", F.explode_outer(F.col("active.prefix")).alias("node"))
    inner = sweep(under.withColumn("key", F.concat(F.coalesce("node", F.lit("")), F.lit("/"), "path")), paths)
    best = inner.withColumn("best", F.get("active", F.size("active") - 1)["rest"])
    won = best.groupBy("_row", "page_id", "host", "path").agg(F.max("best").alias("best"))
    return won.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
