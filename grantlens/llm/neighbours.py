"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors: a graph of nearest neighbours, a balanced partitioning of that graph, and a small network that learns
in which parts a vector's neighbours lie. Every vector is indexed under its likeliest part. A query searches its likeliest parts, as many as
the sample needed for the wanted recall, and all vectors found there are ranked by their exact cosine.

Equal vectors are one index entry with their smallest ids, so a vector that many rows share costs one row. Parts are cut into blocks of
bounded size; blocks of queries meet blocks of candidates by part, whatever the sizes of parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, shared, staged

NEAREST = 5
SAMPLE = 6000  # vectors that the partition is learned on, at most
PARTS, PART_ROWS = 32, 64  # parts, and sampled vectors in a part at least
GRAPH, HIDDEN, EPOCHS = 10, 64, 25
RECALL = 0.97  # wanted on sampled vectors that training left out
BLOCK = 4096  # vectors in a block
WAITING = 50_000  # different vectors that a task gathers before it hands them on


@dataclass
class Router:
    """The network that gives a vector's parts; probes is how many of them a query visits."""

    first: np.ndarray
    second: np.ndarray
    probes: int = 1

    def parts(self, vectors: np.ndarray) -> np.ndarray:
        """Log odds of each part, for unit vectors."""
        return _with_one(np.maximum(_with_one(vectors) @ self.first, 0)) @ self.second


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each unit vector."""
    out = []
    for at in range(0, len(x), 500):
        near = x[at:at + 500] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out.append(np.argpartition(-near, min(k, len(x) - 1) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(graph: np.ndarray, parts: int, random: np.random.Generator) -> np.ndarray:
    """Cut a neighbour graph into parts of nearly equal size with few edges between them.

    Parts grow from random nodes along edges until they are full; then nodes move to the part that most of their neighbours are in, as
    far as sizes stay within a tenth of the mean.
    """
    n = len(graph)
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            back[j].append(i)
    near = [list({*row, *back[i]}) for i, row in enumerate(graph.tolist())]
    part, room = np.full(n, -1), -(-n // parts)
    order, p, size = random.permutation(n).tolist(), 0, 0
    waiting: list[int] = []
    at = 0
    while at < n or waiting:
        if size == room:
            p, size, waiting = p + 1, 0, []
        node = waiting.pop(0) if waiting else order[at]
        if not waiting and node == order[min(at, n - 1)]:
            at += 1
        if part[node] >= 0:
            if at >= n and not waiting:
                break
            continue
        part[node] = p
        size += 1
        waiting += [j for j in near[node] if part[j] < 0]
    count = np.bincount(part, minlength=parts)
    most, least = 1.1 * n / parts, 0.9 * n / parts
    for _ in range(10):
        moved = 0
        for i in random.permutation(n).tolist():
            votes = np.bincount(part[near[i]], minlength=parts)
            best = int(votes.argmax())
            if best != part[i] and votes[best] > votes[part[i]] and count[best] < most and count[part[i]] > least:
                count[part[i]] -= 1
                count[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


def fit(vectors: np.ndarray, seed: int = 3) -> Router:
    """Learn parts and router from a sample of vectors; choose the probes on the tenth that training leaves out."""
    random = np.random.default_rng(seed)
    x = unit(vectors.astype(float)) if len(vectors) else np.zeros((0, vectors.shape[1]))
    parts = max(1, min(PARTS, len(x) // PART_ROWS))
    router = Router(random.normal(0, 1 / np.sqrt(x.shape[1] + 1), (x.shape[1] + 1, HIDDEN)), random.normal(0, 0.1, (HIDDEN + 1, parts)))
    if parts == 1:
        return router
    graph = _graph(x, GRAPH)
    part = balanced_parts(graph, parts, random)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    np.add.at(wanted, (np.arange(len(x)), part), 2.0)
    wanted /= wanted.sum(axis=1, keepdims=True)
    held = random.random(len(x)) < 0.1
    own = np.flatnonzero(~held)
    state = [[np.zeros_like(w), np.zeros_like(w)] for w in (router.first, router.second)]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(own)
        for at in range(0, len(order), 128):
            rows = order[at:at + 128]
            a = _with_one(x[rows])
            h = np.maximum(a @ router.first, 0)
            z = _with_one(h) @ router.second
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = (z / z.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            down = (error @ router.second[:-1].T) * (h > 0)
            step += 1
            for w, g, (m, v) in zip((router.first, router.second), (a.T @ down, _with_one(h).T @ error), state):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    odds = router.parts(x)
    home = odds.argmax(axis=1)
    asked = np.flatnonzero(held)[:500]
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-near, axis=1)[:, :NEAREST]
    rank = np.argsort(np.argsort(-odds[asked], axis=1), axis=1)  # place of each part in a query's order
    visit = rank[np.arange(len(asked))[:, None], home[best]]
    for router.probes in range(1, parts + 1):
        if (visit < router.probes).mean() >= RECALL:
            break
    return router


def _matrix(values: pa.Array) -> np.ndarray:
    """Packed vectors of equal length as rows of doubles."""
    first = values[0].as_buffer().size // 8 if len(values) else 1
    return np.frombuffer(b"".join(values.to_pylist()), np.float64).reshape(len(values), first)


def entries(vectors: DataFrame, nearest: int, every: int) -> DataFrame:
    """vector, ids, query: each different usable vector with its smallest nearest + 1 ids, and whether a query has it."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, tuple[list[int], bool]] = {}
        for batch in batches:
            here: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column("vec_id").to_pylist(), _bytes(batch.column("v"))):
                here.setdefault(v, []).append(i)
            for v, more in here.items():
                ids, query = found.get(v, ([], False))
                found[v] = sorted(ids + more)[:nearest + 1], query or any(i % every == 0 for i in more)
            if len(found) > WAITING:
                yield rows(found)
                found = {}
        yield rows(found)

    def rows(found: dict[bytes, tuple[list[int], bool]]) -> pa.RecordBatch:
        ids, query = zip(*found.values()) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(ids, pa.list_(pa.int64())), pa.array(query, pa.bool_())], ["vector", "ids", "query"])

    packed = vectors.mapInArrow(pack, "vector binary, ids array<long>, query boolean")
    # A vector has one row for each task that holds it (or for every WAITING different ones there), with nearest + 1 ids at most.
    return packed.groupBy("vector").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, nearest + 1).alias("ids"), F.max("query").alias("query"))


def _bytes(lists: pa.Array) -> list[bytes]:
    flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    width = len(flat) // max(len(lists), 1)
    raw = flat.tobytes()
    return [raw[8 * width * i:8 * width * (i + 1)] for i in range(len(lists))]


def usable(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles): vectors that are not null or zero and hold only finite numbers, of the commonest length."""
    v = F.col(vector).cast("array<double>")
    infinite = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    read = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", infinite) & F.exists("v", lambda x: x != 0.0))
    top = read.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return read.where(F.size("v") == (top["n"] if top else 0))


def _shards(rows: DataFrame, size: int) -> DataFrame:
    """part, shards: how many blocks of about `size` each part has; one row for each part."""
    return rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("shards"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """part, shard, ids, vectors: rows (part, id list, vector) of a part in blocks of about `size`."""

    def pack(table: pa.Table) -> pa.Table:
        return pa.table({"part": column(table, "part").slice(0, 1), "shard": column(table, "shard").slice(0, 1), "vectors": pa.array([b"".join(column(table, "vector").to_pylist())], pa.binary()),
                         "ids": pa.array([column(table, "ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})

    dealt = rows.join(F.broadcast(_shards(rows, size)), "part").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    return dealt.groupBy("part", "shard").applyInArrow(lambda t: pack(t), "part int, shard int, vectors binary, ids array<array<long>>")


def search(table: DataFrame, nearest: int = NEAREST, every: int = 50, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by `every` its nearest other rows by cosine, ties to smaller ids.

    Null, zero and non-finite vectors, vectors of another length than most, and null ids take no part. Rows that repeat an id are
    candidates each, and a query leaves out one row with its id. A query whose parts hold fewer candidates than asked for is searched
    again in all parts, so only a table with fewer candidates gives fewer rows; an empty one gives none. Other columns are not read.
    """
    spark = table.sparkSession
    rows = usable(table, vector)
    index = staged(entries(rows, nearest, every))
    sample = index.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    learned = fit(_matrix(pa.array([bytes(r["vector"]) for r in sample], pa.binary())))
    router = shared(spark, learned)

    def route(probes: int, ids: str):
        def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                parts = np.argsort(-router().parts(unit(_matrix(batch.column("vector")))), axis=1, kind="stable")[:, :probes]
                take = pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(parts.ravel().astype(np.int32)), batch.column("vector").take(take), batch.column(ids).take(take)],
                                                 ["part", "vector", "ids"])
        return routed

    place = "part int, vector binary, ids array<long>"
    queries = staged(index.where("query").select("vector", F.array(F.monotonically_increasing_id()).alias("ids")))
    homes = staged(index.select("vector", "ids").mapInArrow(route(1, "ids"), place))
    held, shards = staged(_blocks(homes, BLOCK)), _shards(homes, BLOCK)

    def met(asking: DataFrame, probes: int) -> DataFrame:
        """query, vec_id, score: the best nearest + 1 candidates of each query in the parts it visits; each block of candidates meets its queries in a task of its own."""
        asked = _blocks(staged(asking.mapInArrow(route(probes, "ids"), place)), BLOCK // 4).select("part", F.col("vectors").alias("asked"), F.col("ids").alias("queries"))
        spread = asked.join(F.broadcast(shards), "part").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))  # as many rows as there are parts
        pairs = spread.join(held, ["part", "shard"])
        found = pairs.select("asked", "queries", "vectors", "ids").mapInArrow(rank, "query long, vec_id long, score double")
        best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return staged(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest + 1).drop("rank"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, q, v, ids in zip(*(batch.column(c) for c in ("asked", "queries", "vectors", "ids"))):
                yield _ranked(a.as_buffer(), q.as_py(), v.as_buffer(), ids.as_py(), nearest)

    top = met(queries, learned.probes)
    candidates = index.agg(F.sum(F.size("ids"))).first()[0] or 0
    if learned.probes < learned.second.shape[1]:
        counts = top.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
        named = queries.withColumn("query", F.get("ids", F.lit(0))).join(counts, "query", "left")
        short = staged(named.where(F.coalesce("n", F.lit(0)) < min(nearest + 1, candidates)).select("vector", "ids"))
        if not short.isEmpty():
            again = met(short, learned.second.shape[1])
            top = top.join(again.select("query").distinct(), "query", "left_anti").unionByName(again)
    own = rows.where(F.col("vec_id") % every == 0).mapInArrow(_keyed, "query_id long, vector binary").join(
        queries.select("vector", F.get("ids", F.lit(0)).alias("query")), "vector").select("query_id", "query")
    near = own.join(top, "query")
    # The query itself is left out once.
    same = Window.partitionBy("query_id", "vec_id").orderBy(F.desc("score"))
    others = near.withColumn("again", F.row_number().over(same)).where((F.col("vec_id") != F.col("query_id")) | (F.col("again") > 1))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(_bytes(batch.column("v")), pa.binary())], ["query_id", "vector"])


def _ranked(asked: pa.Buffer, queries: list, held: pa.Buffer, ids: list, nearest: int) -> pa.RecordBatch:
    """The best nearest + 1 candidates of a block for each query: found by matrix product, scored one by one."""
    q, v = (np.frombuffer(x, np.float64).reshape(len(n), -1) for x, n in ((asked, queries), (held, ids)))
    size_q, size_v = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    out: list[tuple[int, int, float]] = []
    for at in range(0, len(q), 256):
        near = (q[at:at + 256] @ v.T) / size_v / size_q[at:at + 256, None]
        keep = min(nearest + 1, len(v))
        least = np.partition(near, len(v) - keep, axis=1)[:, len(v) - keep] - 1e-9
        row, col = np.nonzero(near >= least[:, None])
        score = (q[at + row] * v[col]).sum(axis=1) / (size_q[at + row] * size_v[col])
        first = np.array([ids[c][0] for c in col.tolist()])
        order = np.lexsort((first, -score, row))
        row, col, score = row[order], col[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        for r, c, s in zip(row[nth <= nearest].tolist(), col[nth <= nearest].tolist(), score[nth <= nearest].tolist()):
            out += [(queries[at + r][0], i, s) for i in ids[c]]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                       pa.array([x[2] for x in out], pa.float64())], ["query", "vec_id", "score"])
