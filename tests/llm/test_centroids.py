"""Centroid clustering: plain Lloyd rounds, kept dot products, odd vectors."""

import hashlib

import numpy as np

from grantlens.llm import centroids
from tools.compare import compare, database

from grantlens.llm.queries import CHECKS, QUERIES


def brute(rows, clusters, rounds, salt="2:"):
    """(vec_id, cluster, distance) with every distance computed anew from Python integers."""
    first = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:clusters]
    at = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in rows]
        for j in range(len(at)):
            of = [v for (_, v), m in zip(rows, mine) if m == j]
            if of:
                at[j] = [sum(x) // len(of) for x in zip(*of)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in rows), key=str), at


def made(n, width, seed, spread=3):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(7, width)) * spread
    return [(int(i), (middle[draw.integers(7)] + draw.normal(size=width)).astype(np.float32).tolist()) for i in range(n)]


def whole(v):
    return [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]


def test_against_plain_rounds(spark):
    rows = made(400, 6, 1) + [(500 + i, [1.0, -1.0, 0.5, 0.0, 0.25, -0.75]) for i in range(150)]  # a group of equal vectors
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    for k, rounds in ((1, 1), (9, 4), (40, 0)):
        found = centroids.clustered(frame, clusters=k, rounds=rounds, dimensions=6)
        want, at = brute([(i, whole(v)) for i, v in rows], k, rounds)
        got = found.rows.collect()
        assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == want
        assert found.centroids.tolist() == at
        for r in got:  # what is kept is exact after every update
            assert r["dots"] == [sum(a * b for a, b in zip(r["vector"], c)) for c in at]


def test_rounds_end_when_nothing_moves(spark):
    frame = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(20)], "vec_id long, embedding array<double>")
    a, b = (centroids.clustered(frame, clusters=3, rounds=n, dimensions=2) for n in (2, 50))
    assert a.centroids.tolist() == b.centroids.tolist() and len(a.centroids) == 3


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.001]), (1, [0.5, -0.001]), (1, [9.0, 9.0]), (2, [0.0, 0.0]), (None, [3.0, 4.0]), (-7, [100.0, 1e-9])]
    bad = [(3, None), (4, []), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, -inf]), (10, [None, 1.0])]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' as cluster", "'y' as vector", "1 as dots", "2 as distance", "3 as inertia").repartition(3)
    for k in (2, 6, 40):
        want, _ = brute([(i, [int(np.floor(x * 256)) for x in v]) for i, v in good], k, 5)
        got = centroids.assigned(frame, clusters=k, dimensions=2).collect()
        assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == want
        assert {r["inertia"] for r in got} == {sum(d for _, _, d in want)}
        for r in got:
            assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
    for empty in (frame.limit(0), frame.where("vec_id > 2")):
        assert centroids.assigned(empty, dimensions=2).collect() == []


def test_sql_on_odd_tables(spark, tmp_path):
    """The registered query and its SQL, on vectors of which many do not take part."""
    rows = made(300, 64, 5, 0.3)
    rows += [(i, v) for i, (_, v) in enumerate(rows[:40])] + [(None, rows[0][1]), (900, None), (901, [1.0] * 63), (902, [float("nan")] * 64), (903, [None] * 64)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/made")
    (next((tmp_path / "made").glob("*.parquet"))).rename(tmp_path / "embeddings.parquet")
    ok, note, _ = compare(spark, database(str(tmp_path)), str(tmp_path), "op11_centroids", QUERIES["op11_centroids"], CHECKS["op11_centroids"])
    assert ok, note
