"""A Merkle manifest of a table, kept as a persistent path-copying tree.

Leaves are hashes of rows, made by Spark's own functions where the table is scanned; only hashes travel further. Each source's leaves are
numbered in ascending doc_id by a range shuffle (counts for each partition and source give the offsets; a source may hold any share
of the rows), and ARITY consecutive nodes become their parent's hash until one is left. ARITY ** LEVELS consecutive nodes form an aligned block: one
block's levels are built together, its top is a node of the next tier, and tiers repeat, distributed, until each source has one subroot.
Subroots are the leaves of the last tree in the same way.

A changed leaf makes a new version of the tree that shares every untouched node with it: inside the leaf's block only its ancestors
are copied, and the version continues in the tiers above along the one path from the block's top to the root. That path (the
siblings on both sides, level by level) is the same for every version of a block, so it comes down the tiers once for each block, ahead of
the block's rows in one sorted stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import discarded, partitions_for, stored

ARITY = 3
LEVELS = 7  # of a block: 2187 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, at long, size long, hash string"
STEPS = "path array<struct<left:string,right:string>>, top string"  # siblings level by level, and the hash at the tree's top
PART_BYTES = 64 << 20  # of hashes, for each shuffle partition


def sha256_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_hash(fields: list[Column]) -> Column:
    """Hash of a row's fields: each is `-` for null, else its UTF-8 bytes after their number and a colon."""
    told = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in (x.cast("string") for x in fields)]
    return F.sha2(F.concat(*told), 256)


def tampered_text() -> Column:
    """The text that somebody changed: without line feeds where 2 divides the checksum of the id; null where nothing changes."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.col("text").contains("\n"), F.replace("text", F.lit("\n"), F.lit("")))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, changed (the leaf of the tampered row; null where it is the same)."""
    whole = [F.col(c) for c in FIELDS[:-1]]
    return (docs.select(*[F.col(c) for c in FIELDS]).withColumn("_other", tampered_text())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    row_hash([*whole, F.col("text")]).alias("leaf"),
                    F.when(F.col("_other").isNotNull(), row_hash([*whole, F.col("_other")])).alias("changed")))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows (tree, ...) with `at`, their place (from 0) in their tree in the order of columns (nulls first), and `size`, the tree's rows.

    No task holds a whole tree: rows are counted for each range partition and tree, and only those counts are added up.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    schema = rows.schema

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, last, at = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            places = []
            for tree in batch.column("tree").to_pylist():
                if last != [tree]:
                    last, at = [tree], 0
                places.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([number] * len(places), pa.int32()), pa.array(places, pa.int64())],
                                             [*batch.schema.names, "_part", "_at"])

    dealt = rows.repartitionByRange(partitions_for(rows, PART_BYTES), *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.mapInArrow(counted, StructType(schema.fields).add("_part", IntegerType()).add("_at", LongType())))
    # One row for each partition and tree, so a tree has at most as many as there are partitions.
    counts = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("tree")
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("tree").alias("_tree"), F.col("_part").alias("_in"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("size"))
    joined = placed.join(offsets, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_in")))
    out = stored(joined.select(*schema.names, (F.col("_before") + F.col("_at")).alias("at"), "size"))
    discarded(placed)
    return out


class Block:
    """The levels over one block's nodes: up to one root where the block is the whole tree, else all levels of a block."""

    def __init__(self, nodes: list[str], whole: bool, arity: int, levels: int):
        self.arity, self.levels = arity, [nodes]
        while len(self.levels[-1]) > 1 if whole else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([sha256_of(*below[i:i + arity]) for i in range(0, len(below), arity)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[dict[str, str]]:
        """The siblings on both sides, joined, of a node and of each of its ancestors below the top."""
        steps = []
        for nodes in self.levels[:-1]:
            first = at - at % self.arity
            steps.append({"left": "".join(nodes[first:at]), "right": "".join(nodes[at + 1:first + self.arity])})
            at //= self.arity
        return steps


def copied(node: str, path: list[dict[str, str]]) -> list[str]:
    """The ancestors of a node that a version copies, from the shared siblings; the last one is the version's root."""
    out = []
    for step in path:
        node = sha256_of(step["left"], node, step["right"])
        out.append(node)
    return out


def _by_block(rows: DataFrame, schema: str, make: Callable[[dict[str, list]], dict[str, list]], arity: int, levels: int) -> DataFrame:
    """`make` of the columns of every block in turn; a block's path (at = -1) comes before its nodes.

    A task holds one block at a time, wherever batches end.
    """
    fields = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    names = rows.columns

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[str, list] = {n: [] for n in names}
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in names}
            keys = list(zip(columns["tree"], columns["block"]))
            out: dict[str, list] = {n: [] for n in fields.names}
            begin = 0
            for i, key in enumerate(keys):
                if have["at"] and i == begin and key != (have["tree"][-1], have["block"][-1]):
                    _add(out, make(have))
                    have = {n: [] for n in names}
                if i + 1 == len(keys) or keys[i + 1] != key:
                    _add(have, {n: columns[n][begin:i + 1] for n in names})
                    begin = i + 1
            yield pa.RecordBatch.from_pydict(out, fields)
        if have["at"]:
            out = make(have)
            yield pa.RecordBatch.from_pydict({n: out[n] for n in fields.names}, fields)

    dealt = rows.repartition(partitions_for(rows, PART_BYTES), "tree", "block").sortWithinPartitions("tree", "block", "at")
    return dealt.mapInArrow(blocks, schema)


def _add(out: dict[str, list], more: dict[str, list]) -> None:
    for name, values in out.items():
        values.extend(more[name])


def _block_of(arity: int, levels: int) -> Column:
    return F.floor(F.col("at") / arity ** levels).cast("long").alias("block")


def tiers(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> list[DataFrame]:
    """The nodes of numbered trees (tree, at, size, hash), the tops of their blocks, the tops of those, until each tree has one node; stored."""
    full = arity ** levels

    def tops(rows: dict[str, list]) -> dict[str, list]:
        size = rows["size"][0]
        return {"tree": rows["tree"][:1], "at": rows["block"][:1], "size": [-(-size // full)],
                "hash": [Block(rows["hash"], size <= full, arity, levels).top]}

    out = [nodes]
    largest = nodes.agg(F.max("size").alias("n")).first()["n"] or 1
    while len(out) == 1 or largest > 1:
        below = out[-1].select("tree", _block_of(arity, levels), "at", "size", "hash")
        out.append(stored(_by_block(below, NODE, tops, arity, levels)))
        largest = -(-largest // full)
    return out


def _under(nodes: DataFrame, above: DataFrame, schema: str, make, arity: int, levels: int) -> DataFrame:
    """`make(rows, block, path, top)` for every block of the nodes, with the path (tree, at, path, top) above its top."""
    full = arity ** levels

    def of_block(rows: dict[str, list]) -> dict[str, list]:
        path, top = rows["path"][0], rows["top"][0]
        rows = {n: v[1:] for n, v in rows.items()}
        return make(rows, Block(rows["hash"], rows["size"][0] <= full, arity, levels), path, top)

    heads = above.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), "path", "top")
    marked = nodes.select("*", _block_of(arity, levels))
    return _by_block(marked.unionByName(heads, allowMissingColumns=True), schema, of_block, arity, levels)


def paths(trees: list[DataFrame], above: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """tree, at, path, top of the nodes one tier above the lowest, given those of the highest tier's nodes."""

    def of_nodes(rows: dict[str, list], block: Block, path: list, top: str) -> dict[str, list]:
        n = range(len(rows["at"]))
        return {"tree": rows["tree"], "at": rows["at"], "path": [block.path(i) + path for i in n], "top": [top for _ in n]}

    for nodes in trees[-2:0:-1]:
        above = stored(_under(nodes, above, f"tree string, at long, {STEPS}", of_nodes, arity, levels))
    return above


def _grown(docs: DataFrame, arity: int, levels: int) -> tuple[DataFrame, DataFrame, str]:
    """Numbered leaves, the paths of the tops of their blocks, and the root."""
    rows = leaves(docs).withColumnRenamed("source", "tree").withColumnRenamed("leaf", "hash")
    of_sources = tiers(numbered(rows, ["doc_id", "hash"]), arity, levels)
    subroots = of_sources[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "hash")
    of_root = tiers(numbered(subroots, ["source"]), arity, levels)
    root = of_root[-1].select("hash").first()
    above = paths(of_root, of_root[-1].select("tree", "at", F.expr("array()").cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("top")), arity, levels)

    def of_subroots(rows: dict[str, list], block: Block, path: list, top: str) -> dict[str, list]:
        n = range(len(rows["at"]))
        return {"tree": rows["source"], "at": [0 for _ in n], "path": [block.path(i) + path for i in n], "top": rows["hash"]}

    per_source = stored(_under(of_root[0], above, f"tree string, at long, {STEPS}", of_subroots, arity, levels))
    return of_sources[0], paths(of_sources, per_source, arity, levels), root["hash"] if root else ""


def manifest(docs: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    `folded_root` is the root of the version that the row's tampering makes (an untampered row's own root), `verified` whether it is
    the manifest's root. Rows that repeat a doc_id follow one another by their hashes; a row without an id comes first, and one without a source
    belongs to the source null; neither is an error. An empty table has no rows. Other columns are not read.
    """
    nodes, above, root = _grown(docs, arity, levels)

    def proofs(rows: dict[str, list], block: Block, path: list, top: str) -> dict[str, list]:
        whole = [block.path(i) + path for i in range(len(rows["at"]))]
        folded = [(copied(changed or leaf, steps) or [changed or leaf])[-1] for changed, leaf, steps in zip(rows["changed"], rows["hash"], whole)]
        return {"doc_id": rows["doc_id"], "leaf": rows["hash"], "subroot": [top for _ in whole], "root": [root for _ in whole],
                "proof_sha256": [sha256_of(*[x for step in steps for x in (step["left"], step["right"])]) for steps in whole],
                "folded_root": folded, "verified": [f == root for f in folded]}

    return _under(nodes, above, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
                  proofs, arity, levels)


def versions(docs: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, height, hash: the nodes that each tampered row's version copies (height 0 is its leaf); all others are shared."""
    nodes, above, _ = _grown(docs, arity, levels)

    def changed(rows: dict[str, list], block: Block, path: list, top: str) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "source": [], "height": [], "hash": []}
        for i, leaf in enumerate(rows["changed"]):
            if leaf is not None:
                new = [leaf, *copied(leaf, block.path(i) + path)]
                _add(out, {"doc_id": [rows["doc_id"][i]] * len(new), "source": [rows["tree"][i]] * len(new), "height": list(range(len(new))), "hash": new})
        return out

    return _under(nodes, above, "doc_id long, source string, height int, hash string", changed, arity, levels)
