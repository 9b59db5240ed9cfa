"""Near duplicates by a size-aware heavy-light join of shingle sets.

A document's set holds the fingerprints of its distinct runs of five words. Equal sets are one class, so copies cost one row. Two
sets A and B with 100 |A & B| >= 75 |A | B| share at least t = ceil(0.75 |A|) elements, so in any common order of elements the first
|A| - t + c of A and of B share c of them. Elements are ordered rarest first.

* Light sets (size up to a boundary) enumerate all pairs (c = 2) of those first elements; sets that share a pair are candidates.
* Heavy sets scan the inverted lists of their first elements (c = 1), which also hold the light sets large enough for them.
* The boundary is the one with the lowest cost: pairs enumerated by light sets plus list entries scanned by heavy sets.

Candidates form groups (connected through lists), and each candidate's set travels once to its group, where overlaps are counted exactly
along inverted lists. Groups above GROUP documents are dealt into blocks; a set travels to its own block and to the meetings with
blocks that hold one of its keys, so each pair that shares a key is compared in one task: no link is lost or counted twice, and no
task holds a whole group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import column, frugal, frugal_groups, in_blocks, joined_bytes, per_block, slices, staged, unpacked
from .components import connected

SHINGLE, PERCENT = 5, 75
BLOCK = 4_000_000  # bytes of text whose element counts travel together
BUCKET = 1_500_000  # elements that one task counts, about
GROUP, GROUP_ELEMENTS = 512, 2_000_000  # documents, and elements, that one task compares


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted fingerprints of the distinct shingles of each text."""
    data, marks = joined_bytes(texts)
    data = W.LOWER[data]
    starts, ends, at = W.bounds(data, marks, W.NOT_SPACE)
    prints = W.fingerprints(data, starts, ends)
    every = W.runs(prints, SHINGLE)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(every[a:b - SHINGLE + 1]))
        else:
            out.append(W.runs(prints[a:b], b - a) if b > a else prints[:0])
    return out


def needed(n: int | np.ndarray) -> np.ndarray:
    """How many elements a set of n shares with any set that it links to, at least."""
    return -(-np.asarray(n) * PERCENT // 100)


def _digest(found: np.ndarray) -> str:
    return hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest()


def _texts(block: pa.Table) -> Iterator[pa.RecordBatch]:
    return slices(block.combine_chunks().to_batches(), "text")


def classes(blocks: DataFrame) -> DataFrame:
    """doc_id, mark, class, n_shingles of every document (class null without words)."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for _, block in per_block(batches) for p in _texts(block)):
            sets = shingle_sets(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), pa.array([_digest(s) if len(s) else None for s in sets], pa.string()),
                                              pa.array([len(s) for s in sets], pa.int64())], ["doc_id", "mark", "class", "n_shingles"])

    return blocks.mapInArrow(frugal(digests), "doc_id long, mark string, class string, n_shingles long")


def _short(found: np.ndarray, bits: int) -> np.ndarray:
    """Elements by their first bits: enough to order them by frequency; equal short forms only share a count."""
    return (found >> np.uint64(64 - bits)).astype(np.uint32 if bits <= 32 else np.uint64)


def shared_elements(blocks: DataFrame, total: int) -> DataFrame:
    """block, elements, uses: the short forms in each block that several documents have, and how many do.

    Copies inside a block count once. A block's distinct elements travel in sorted lots, one for each range of elements.
    """
    buckets = max(1, -(-total // BUCKET))
    bits = 32 if total < 1 << 28 else 64
    kind = np.uint32 if bits == 32 else np.uint64

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in per_block(batches):
            different = {s.tobytes() for part in _texts(texts) for s in shingle_sets(part.column("text")) if len(s)}
            if not different:
                continue
            found, n = np.unique(np.concatenate([_short(np.frombuffer(s, np.uint64), bits) for s in different]), return_counts=True)
            bucket = (found.astype(np.float64) * (buckets / 2.0 ** bits)).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)])).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]]), pa.array(np.full(len(cuts) - 1, block)),
                 pa.array([found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                 pa.array([n[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], ["bucket", "block", "elements", "uses"])

    def count(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(x.as_buffer(), kind) for x in column(table, "elements")]
        uses = [np.frombuffer(x.as_buffer(), np.uint32) for x in column(table, "uses")]
        distinct, where = np.unique(np.concatenate(found), return_inverse=True)
        total = np.bincount(where, np.concatenate(uses), len(distinct)).astype(np.uint32)[where]
        out, at = [], 0
        for block, f in zip(column(table, "block").to_pylist(), found):
            n = total[at:at + len(f)]
            at += len(f)
            several = n > 1
            if several.any():
                out.append((block, f[several].tobytes(), n[several].tobytes()))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "elements": pa.array([x[1] for x in out], pa.binary()),
                         "uses": pa.array([x[2] for x in out], pa.binary())})

    sent = blocks.mapInArrow(frugal(lots), "bucket long, block long, elements binary, uses binary")
    return sent.groupBy("bucket").applyInArrow(frugal_groups(count, 1), "block long, elements binary, uses binary")


def boundary(sizes: dict[int, int], scanned: float) -> int:
    """The largest size that enumerates pairs, by the total of pairs made and list entries scanned."""
    best, at = math.inf, 0
    listed = sorted(sizes)
    for x in [0, *listed]:
        if x > 200:
            break
        cost = 0.0
        for n in listed:
            first = n - int(needed(n))
            if n <= x:
                cost += sizes[n] * math.comb(first + 2, 2)
            if n > x or n >= needed(x + 1):
                cost += sizes[n] * (first + 1) * scanned
        if cost < best:
            best, at = cost, x
    return at


def signatures(blocks: DataFrame, shared: DataFrame, total: int, light: int) -> DataFrame:
    """class, n, found, keys: candidates' sets (packed) with the keys under which they meet others."""
    bits = 32 if total < 1 << 28 else 64
    kind = np.uint32 if bits == 32 else np.uint64

    def keys(texts: pa.Table, told: pa.Table) -> pa.Table:
        known = [np.frombuffer(x.as_buffer(), kind) for x in column(told, "elements")]
        uses = [np.frombuffer(x.as_buffer(), np.uint32) for x in column(told, "uses")]
        known, uses = (np.concatenate(known), np.concatenate(uses)) if known else (np.zeros(0, kind), np.zeros(0, np.uint32))
        order = np.argsort(known, kind="stable")
        known, uses = known[order], uses[order]
        rows, seen = [], set()
        for part in (p for block in unpacked(column(texts, "texts")) for p in _texts(block)):
            for s in shingle_sets(part.column("text")):
                n = len(s)
                if n < 2 or not len(known):
                    continue
                short = _short(s, bits)
                at = np.minimum(np.searchsorted(known, short), len(known) - 1)
                n_uses = np.where(known[at] == short, uses[at], 1)
                chosen = _first_keys(s, n_uses, light)
                if len(chosen):
                    name = _digest(s)
                    if name not in seen:
                        seen.add(name)
                        rows.append((name, s.tobytes(), chosen.view(np.int64)))
        return pa.table({"class": pa.array([r[0] for r in rows], pa.string()), "n": pa.array([len(r[1]) // 8 for r in rows], pa.int64()), "found": pa.array([r[1] for r in rows], pa.binary()),
                         "keys": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})

    both = blocks.groupBy("block").cogroup(shared.groupBy("block"))
    return both.applyInArrow(frugal_groups(keys, 4), "class string, n long, found binary, keys array<long>").dropDuplicates(["class"])


def _first_keys(s: np.ndarray, uses: np.ndarray, light: int) -> np.ndarray:
    """Keys of one set: single elements for inverted lists, or pairs, of its rarest elements; nobody else has elements used once."""
    n = len(s)
    spare = n - int(needed(n))
    rarest = np.lexsort((s, uses))[:spare + 2]
    out = []
    if n > light or n >= needed(light + 1):
        first = rarest[:spare + 1]
        out.append(W.mixed(s[first[uses[first] > 1]]))
    if n <= light:
        first = np.sort(s[rarest[uses[rarest] > 1]])
        a, b = np.triu_indices(len(first), 1)
        out.append(W.mixed(W.mixed(first[a]) * np.uint64(3) + first[b]))
    return np.concatenate(out)


def matched(sets: list[np.ndarray], side: np.ndarray | None = None, percent: int = PERCENT) -> Iterator[tuple[int, np.ndarray]]:
    """(i, the j < i that i links to), by counting overlaps along inverted lists. With sides, only pairs from different sides."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    own = np.repeat(np.arange(len(sets)), size)
    _, element = np.unique(flat, return_inverse=True)
    order = np.lexsort((own, element))
    lists, first = own[order], np.searchsorted(element[order], np.arange(element.max(initial=-1) + 2))
    marks = np.concatenate(([0], np.cumsum(size)))
    for i in range(len(sets)):
        mine = element[marks[i]:marks[i + 1]]
        begin, n = first[mine], first[mine + 1] - first[mine]
        several = n > 1
        if not several.any():
            continue
        others = lists[W.ranges(begin[several], n[several])]
        common = np.bincount(others[others < i], minlength=1)
        j = np.flatnonzero(common)
        linked = 100 * common[j] >= percent * (size[i] + size[j] - common[j])
        if side is not None:
            linked &= side[i] != side[j]
        yield i, j[linked]


def _linked(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Links of a meeting: of one block with itself, or between two blocks."""
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in column(table, "found")]
    between = table.num_rows and column(table, "low")[0] != column(table, "high")[0]
    return matched(sets, column(table, "block").to_numpy() if between else None)


def _pairs(table: pa.Table) -> pa.Table:
    """class, other: every link of a meeting."""
    names = column(table, "class")
    found = [(np.full(len(j), i), j) for i, j in _linked(table)]
    here, there = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), ())))
    return pa.table({"class": names.take(pa.array(here)), "other": names.take(pa.array(there))})


def _sums(table: pa.Table) -> pa.Table:
    """The links of a meeting in short: a spanning forest (class, other), and of each class (other null) how many rows it links to here."""
    names = column(table, "class").to_pylist()
    rows = column(table, "rows").to_numpy()
    total = np.zeros(len(names), np.int64)
    above = list(range(len(names)))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    out = []
    for i, linked in _linked(table):
        total[i] += rows[linked].sum()
        total[linked] += rows[i]
        for j in linked.tolist():
            a, b = top(i), top(j)
            if a != b:
                above[a] = b
                out.append((names[i], names[j], None))
    out += [(names[i], None, total[i]) for i in np.flatnonzero(total)]
    return pa.table({"class": pa.array([x[0] for x in out], pa.string()), "other": pa.array([x[1] for x in out], pa.string()),
                     "n": pa.array([x[2] for x in out], pa.int64())})


def meetings(candidates: DataFrame, told: DataFrame, group: int = GROUP, name: str = "rows") -> DataFrame:
    """group, low, high, block, class, rows, found: the candidates' sets, so that any two that share a key meet in one (group, low, high).

    A group is one block, or dealt into blocks; a set visits the blocks that hold its keys, so two sets that share one meet once.
    candidates: class, n, found, keys; stored. told: class and a column of this name that travels with it.
    """
    keys = candidates.select("class", F.explode("keys").alias("key"))
    firsts = keys.groupBy("key").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    together = connected(keys.join(firsts, "key").where(F.col("class") != F.col("first")).select(F.col("first").alias("a"), F.col("class").alias("b")).distinct())
    places = candidates.select("class", "n").join(together.select(F.col("node").alias("class"), F.col("part").alias("group")), "class")
    many = places.groupBy("group").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("elements"))
    blocks = F.greatest(F.ceil(F.col("many") / group), F.ceil(F.col("elements") / GROUP_ELEMENTS)).cast("int")
    # Stored: the join then reads both sides from a shuffle, and a group of very many classes is split. Only groups of several blocks are in it.
    several = staged(many.select("group", blocks.alias("blocks")).where("blocks > 1"))
    count = F.coalesce("blocks", F.lit(1))
    placed = (places.join(several, "group", "left").join(told, "class")
              .select("class", name, "group", count.alias("blocks"), F.pmod(F.xxhash64("class"), count).cast("int").alias("block")))
    return candidates.select("class", "found").join(_visits(placed, keys, name), "class").select("group", "low", "high", "block", "class", name, "found")


def _visits(placed: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """class, the told column, group, block, low, high: the meetings of each class.

    Classes of large groups meet only those blocks of their group in which another class has a key of theirs, and their own.
    """
    placed = staged(placed)
    own = F.col("block")
    meet = placed.select("class", name, "group", "block", own.alias("low"), own.alias("high"))
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return meet
    held = staged(keys.join(large.select("class", "block"), "class"))
    spread = held.groupBy("key").agg(F.collect_set("block").alias("others")).where("size(others) > 1")  # as many as a group has blocks
    other = held.join(spread, "key").select("class", "block", F.explode("others").alias("other")).where("other != block").distinct()
    across = large.join(other.select("class", "other"), "class").select(
        "class", name, "group", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return meet.unionByName(across)


def _mark() -> Column:
    """What tells the texts of rows with one id apart."""
    return F.md5(F.coalesce("text", F.lit("")))


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class (stored), classes (class, first, rows, n), and the candidates' sets with their keys (stored)."""
    blocks = in_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark().alias("mark"), F.col("text").alias("text")), BLOCK)
    named = staged(classes(blocks))
    of_class = named.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"), F.first("n_shingles").alias("n"))
    sizes = {r["n"]: r["count"] for r in of_class.groupBy("n").count().collect()}  # as many rows as there are sizes
    total = sum(n * many for n, many in sizes.items())
    shared = staged(shared_elements(blocks, total))
    lists = shared.agg(F.sum(F.length("uses") / 4).alias("n")).first()["n"] or 0
    light = boundary(sizes, 1 + lists / max(1, total))
    return named, of_class, staged(signatures(blocks, shared, total, light))


def links(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """class, other (class < other): every pair of different classes that link, once.

    Documents of one class link with each other as well; `classes` names the class of a document. A group of near copies has as many
    rows here as it has pairs; `linked` counts them without making them.
    """
    _, of_class, candidates = _prepared(docs)
    met = meetings(candidates, of_class.select("class", "rows"), group)
    found = met.groupBy("group", "low", "high").applyInArrow(frugal_groups(_pairs), "class string, other string")
    return found.select(F.least("class", "other").alias("class"), F.greatest("class", "other").alias("other"))


def _components(docs: DataFrame, group: int) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, mark, class, n_shingles), and the classes' component (part), component_id and n_links."""
    named, of_class, candidates = _prepared(docs)
    met = meetings(candidates, of_class.select("class", "rows"), group)
    found = staged(met.groupBy("group", "low", "high").applyInArrow(frugal_groups(_sums), "class string, other string, n long"))
    parts = connected(found.where("other IS NOT NULL").select(F.col("class").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("class"), "part")
    counts = found.where("other IS NULL").groupBy("class").agg(F.sum("n").alias("n_links"))
    ids = of_class.select("class", "first", "rows").join(parts, "class", "left").join(counts, "class", "left").withColumn("part", F.coalesce("part", "class"))
    smallest = staged(ids.groupBy("part").agg(F.min("first").alias("component_id")))
    return named, ids.join(smallest, "part").select("class", "part", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))


def linked(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and n_links (how many other rows it links with) of every document.

    Rows of one class link with each other. Texts without words (or null) have an empty set and link with nothing; their component is
    their own id. Rows that repeat a text are one class; a class without any id has a null component. Very long texts are read whole. An
    empty table has no rows. Other columns are not read.
    """
    named, of_classes = _components(docs, group)
    alone = F.col("class").isNull()
    return named.join(of_classes, "class", "left").select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def components(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id of every document, as `linked` has them."""
    return linked(docs, group).drop("n_links")


def one_of_each(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One document of each group of near duplicates, with all its columns: the one with the smallest id.

    Documents are told apart by id and text, so different texts under one id are judged each for itself; rows that agree in both are
    one document. Among several texts under the smallest id, or where no document of a group has an id, the smallest hash of the text
    stays. Documents without words link with nothing and stay.
    """
    named, of_classes = _components(docs, group)
    key = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark")
    grouped = named.join(of_classes.select("class", "part"), "class")
    chosen = grouped.groupBy("part").agg(F.min(key).alias("k")).select("k.doc_id", "k.mark")
    wordless = named.where("class IS NULL").select("doc_id", "mark")
    kept = chosen.unionByName(wordless).distinct().select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    marked = docs.withColumn("_own", _mark())
    rows = marked.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_mark")), "left_semi")
    return rows.dropDuplicates(["doc_id", "_own"]).drop("_own")
