"""Near duplicates by min-max hashing.

A document's set holds the fingerprints of its distinct runs of five words; equal sets are one class, so copies cost one row. Each permutation of the
fingerprints is evaluated once and gives two values of the signature, its minimum and its maximum; both agree between two sets with a
probability equal to their similarity, and together they vary less than two independent minima. BANDS bands of two permutations (four
values) each are hashed to a key. Two sets of similarity 0.85 share no key with a probability below 2e-10.

Sets that share a key are confirmed on the full sets, without comparing all pairs of a group: every class first meets the smallest class
of each of its keys, which ties a group of near copies to one star with as many comparisons as it has members. Then only keys whose
other members are still in different components need more; those members meet in blocks (each pair of blocks in one task, by
inverted lists), so that every two classes that share a key are either connected or compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import column, discarded, frugal, frugal_groups, in_blocks, per_block, slices, stored, unpacked
from .components import connected
from .jaccard import GROUP, matched, meetings, shingle_sets

PERCENT = 85
BANDS, PERMUTATIONS = 32, 2  # permutations in a band: two values each
BLOCK = 4_000_000  # bytes of text in a block
CHUNK = 1 << 18  # fingerprints hashed at once
SEED = 20


def permutations(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """n permutations of the 64-bit numbers: x -> (x ^ offset) * odd number."""
    draw = np.random.default_rng(seed)
    return draw.integers(0, 1 << 64, n, np.uint64), draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], n: int, seed: int = SEED) -> np.ndarray:
    """Minimum and maximum of every non-empty set under each permutation: (sets, n, 2)."""
    out = np.empty((len(sets), n, 2), np.uint64)
    offsets, factors = permutations(n, seed)
    for part in _parts(sets):
        flat = np.concatenate(sets[part])
        first = np.cumsum([0, *map(len, sets[part])])[:-1]
        for k in range(n):
            values = (flat ^ offsets[k]) * factors[k]
            out[part, k, 0] = np.minimum.reduceat(values, first)
            out[part, k, 1] = np.maximum.reduceat(values, first)
    return out


def _parts(sets: list[np.ndarray]) -> Iterator[slice]:
    begin, size = 0, 0
    for i, s in enumerate(sets):
        if size and size + len(s) > CHUNK:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(s)
    if begin < len(sets):
        yield slice(begin, len(sets))


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands): one hash of each band's values and its number."""
    values = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), values.shape[:2]).copy()
    for k in range(values.shape[2]):
        key = W.mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
    return key


def _name(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signed(blocks: DataFrame, bands: int = BANDS, permutations_each: int = PERMUTATIONS) -> DataFrame:
    """doc_id, class, n_shingles, block, bands of every document (class and bands null without words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in per_block(batches):
            for part in slices(texts.combine_chunks().to_batches(), "text"):
                sets = shingle_sets(part.column("text"))
                at = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(signatures([sets[i] for i in at], bands * permutations_each), bands).view(np.int64).tolist()
                of = dict(zip(at, keys))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([_name(s) if len(s) else None for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([block] * len(sets), pa.int64()), pa.array([of.get(i) for i in range(len(sets))], pa.list_(pa.int64()))],
                    ["doc_id", "class", "n_shingles", "block", "bands"])

    return blocks.mapInArrow(frugal(sign), "doc_id long, class binary, n_shingles long, block long, bands array<long>")


def _sets(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, found: the packed sets of the wanted classes (class, block)."""

    def pick(texts: pa.Table, told: pa.Table) -> pa.Table:
        names = set(column(told, "class").to_pylist())
        rows = []
        for block in unpacked(column(texts, "texts")) if names else []:
            for part in slices(block.combine_chunks().to_batches(), "text"):
                for s in shingle_sets(part.column("text")):
                    if len(s) and (name := _name(s)) in names:
                        names.discard(name)
                        rows.append((name, s.tobytes()))
        return pa.table({"class": pa.array([r[0] for r in rows], pa.binary()), "found": pa.array([r[1] for r in rows], pa.binary())})

    return blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(frugal_groups(pick, 4), "class binary, found binary")


def _confirmed(pairs: DataFrame) -> DataFrame:
    """a, b: the pairs (a, b, a_found, b_found) whose sets link. Rows of one b follow one another, and b's set is unpacked once."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, theirs = None, None
        for batch in batches:
            keep = []
            a, b = batch.column("a_found"), batch.column("b_found")
            for i, other in enumerate(batch.column("b").to_pylist()):
                if other != name:
                    name, theirs = other, np.frombuffer(b[i].as_buffer(), np.uint64)
                mine = np.frombuffer(a[i].as_buffer(), np.uint64)
                common = int((theirs[np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)] == mine).sum())
                keep.append(100 * common >= PERCENT * (len(mine) + len(theirs) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "a_found", "b_found").mapInArrow(frugal(check), "a binary, b binary")


def _linked_in_block(table: pa.Table) -> pa.Table:
    """a, b: links of a meeting between classes of different components."""
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in column(table, "found")]
    between = table.num_rows and column(table, "low")[0] != column(table, "high")[0]
    names, parts = column(table, "class").to_pylist(), column(table, "part").to_pylist()
    out = [(names[i], names[j]) for i, linked in matched(sets, column(table, "block").to_numpy() if between else None, PERCENT) for j in linked.tolist() if parts[i] != parts[j]]
    return pa.table({"a": pa.array([x[0] for x in out], pa.binary()), "b": pa.array([x[1] for x in out], pa.binary())})


def confirmed_links(blocks: DataFrame, classes: DataFrame, group: int = GROUP) -> DataFrame:
    """a, b: links between classes (class, n, block, bands; stored) that connect all classes which links connect."""
    members = classes.select("class", "n", F.explode("bands").alias("key"))
    # Stored, so that the join below reads both sides from a shuffle and a key of very many classes can be split.
    firsts = stored(members.groupBy("key").agg(F.min(F.struct("class", "n")).alias("rep"), F.count(F.lit(1)).alias("many")).where("many > 1").drop("many"))
    met = stored(members.join(firsts, "key").where(F.col("class") != F.col("rep.class")))
    large, small = F.greatest("n", "rep.n"), F.least("n", "rep.n")
    asked = stored(met.where(100 * small >= PERCENT * large).select(F.col("class").alias("a"), F.col("rep.class").alias("b")).distinct())
    # The classes whose sets are compared: those asked for above, and those that may meet again below.
    again = met.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("key")
    several = stored(again)
    rest = stored(met.join(several, "key").select("key", "class", "n"))
    names = asked.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = stored(_sets(blocks, classes.join(names, "class", "left_semi").select("class", "block")))
    of_a, of_b = (sets.select(F.col("class").alias(x), F.col("found").alias(f"{x}_found")) for x in "ab")
    stars = stored(_confirmed(asked.join(of_a, "a").join(of_b, "b")))
    discarded(firsts, met, asked, sets, several)
    parts = stored(connected(stars).select(F.col("node").alias("class"), "part"))
    placed = stored(rest.join(parts, "class", "left").withColumn("part", F.coalesce("part", "class")))
    open_keys = stored(placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high").select("key"))
    left = stored(placed.join(open_keys, "key"))
    discarded(rest, parts, placed, open_keys)
    if left.isEmpty():
        return stars
    candidates = left.groupBy("class", "part", "n").agg(F.collect_set("key").alias("keys"))  # as many as there are bands
    found = _sets(blocks, classes.join(left.select("class").distinct(), "class", "left_semi").select("class", "block"))
    candidates = stored(candidates.join(found, "class"))
    visits = meetings(candidates, candidates.select("class", "part"), group, "part")
    return stars.unionByName(stored(visits.groupBy("group", "low", "high").applyInArrow(frugal_groups(_linked_in_block), "a binary, b binary")))


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept (doc_id = component_id) of every document.

    Rows that repeat a text are one class and link with each other. Texts without words (or null) have an empty set and link with
    nothing; their component is their own id. A class without any id has a null component, and `kept` is null for rows without an id.
    Very long texts are read whole. An empty table has no rows. Other columns are not read.
    """
    blocks = in_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), BLOCK)
    named = stored(signed(blocks))
    of_class = named.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("block", "n_shingles", "bands")).alias("one"))
    classes = stored(of_class.select("class", "first", "one.block", F.col("one.n_shingles").alias("n"), "one.bands"))
    parts = connected(confirmed_links(blocks, classes, group)).select(F.col("node").alias("class"), "part")
    ids = classes.select("class", "first").join(parts, "class", "left").withColumn("part", F.coalesce("part", "class"))
    smallest = stored(ids.groupBy("part").agg(F.min("first").alias("component_id")))
    of_classes = stored(ids.join(smallest, "part").select("class", "component_id"))
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "n_shingles", "class").join(of_classes, "class", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
