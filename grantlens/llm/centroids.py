"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector keeps its exact integer dot product with every centroid, in a table of the shared folder. A round moves a centroid by
whole numbers; a dot product changes by the vector's components times those moves, and only components that moved are
touched. The squared distance |v|^2 - 2 v.c + |c|^2 follows from the kept numbers, so assignments are a new argmin and nothing is
computed anew. New centroids are sums over each cluster, added up inside Spark's tasks first; only clusters x dimensions
numbers reach the driver, whatever the number of vectors. The table of the round before is deleted as soon as the next one is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discarded, lists, stored

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SALT = 64, 40, 5, 256, "2:"
LIMIT = 1 << 27  # of a component: below it no sum of 64 products leaves 64 bits
ROWS = "vec_id long, vector array<int>, square long, dots array<long>, cluster int, distance long"


@dataclass
class Clusters:
    """rows: vec_id, vector, square, dots, cluster, distance (stored); centroids: one row of components for each cluster."""

    rows: DataFrame
    centroids: np.ndarray


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, vector: floor(scale * component) of the vectors with exactly `dimensions` finite components; the others are left out.

    A component of 2^27 or more (an input of half a million at scale 256) is an error, since distances would not fit into 64 bits.
    """
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.when(F.abs(c * scale) < LIMIT, F.floor(c * scale)).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return x.where((F.size("v") == dimensions) & finite).select("vec_id", F.transform("v", whole).cast("array<int>").alias("vector"))


def _matrix(lists_of_numbers: pa.Array, width: int) -> np.ndarray:
    return lists_of_numbers.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _batch(batch: pa.RecordBatch, square: np.ndarray, dots: np.ndarray, centres: np.ndarray) -> pa.RecordBatch:
    """The rows with their nearest centroid (ties: the smaller number) by the kept numbers."""
    distance = square[:, None] - 2 * dots + centres
    nearest = distance.argmin(axis=1)
    marks = np.arange(len(dots) + 1) * dots.shape[1]
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("vector"), pa.array(square), lists(dots.ravel(), marks, pa.int64()),
         pa.array(nearest, pa.int32()), pa.array(distance[np.arange(len(dots)), nearest])], ["vec_id", "vector", "square", "dots", "cluster", "distance"])


def _first(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """All dot products, computed once."""
    width, centres = centroids.shape[1], (centroids ** 2).sum(axis=1)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("vector"), width)
            yield _batch(batch, (v ** 2).sum(axis=1), v @ centroids.T, centres)

    return vectors.mapInArrow(multiplied, ROWS)


def _moved(rows: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The rows after centroids moved: dot products change by the components that did."""
    width, moves, centres = after.shape[1], after - before, (after ** 2).sum(axis=1)
    changes = [(j, np.flatnonzero(moves[j])) for j in range(len(moves)) if moves[j].any()]

    def updated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, dots = _matrix(batch.column("vector"), width), _matrix(batch.column("dots"), len(moves))
            for j, at in changes:
                dots[:, j] += v[:, at] @ moves[j, at]
            yield _batch(batch, batch.column("square").to_numpy(), dots, centres)

    return rows.mapInArrow(updated, ROWS)


def _means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of each cluster's mean; an empty cluster keeps its centroid."""
    out = centroids.copy()
    sums = [F.sum(F.get("vector", F.lit(i))).alias(f"s{i}") for i in range(centroids.shape[1])]
    for r in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # one row for each cluster
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(centroids.shape[1])]
    return out


def seeds(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> list[list[int]]:
    """The vectors whose id has the smallest hash, in the order of hashes: at most `clusters` rows, from a limit inside each task.

    Rows that repeat an id follow one another by their components; rows without an id come last.
    """
    hashed = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    return [r["vector"] for r in vectors.orderBy(hashed.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()]


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, salt: str = SALT) -> Clusters:
    """Lloyd's rounds over the integer vectors, then a last assignment. Fewer vectors than clusters give as many clusters as vectors."""
    whole = integers(vectors, dimensions, scale)
    centroids = np.array(seeds(whole, clusters, salt), np.int64).reshape(-1, dimensions)
    if not len(centroids):
        return Clusters(vectors.sparkSession.createDataFrame([], ROWS), centroids)
    rows = stored(_first(whole, centroids))
    for _ in range(rounds):
        means = _means(rows, centroids)
        if (means == centroids).all():
            break  # no later round changes anything
        moved = stored(_moved(rows, centroids, means))
        discarded(rows)
        rows, centroids = moved, means
    return Clusters(rows, centroids)


def assigned(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part.

    Vectors that are null, of another length, or hold null or non-finite components are left out; every other row is returned, also
    rows that repeat an id or have none. An empty table gives an empty result. Other columns are not read.
    """
    found = clustered(vectors, **options)
    spark = vectors.sparkSession
    sums = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()  # one row for each cluster
    total = sum(int(r["n"]) for r in sums)
    told = [(r["cluster"], int(r["n"]), total, hashlib.sha256(",".join(map(str, found.centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in sums]
    of_cluster = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.select("vec_id", "cluster", "distance").join(F.broadcast(of_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
