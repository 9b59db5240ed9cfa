"""Nearest neighbours: exact scores and order, recall against brute force, odd vectors."""

import collections

import numpy as np
import pytest

from grantlens.llm import neighbours


def brute(ids, vectors, k=5, every=50):
    ids, v = np.array(ids), np.array(vectors, float)
    size = np.sqrt((v * v).sum(axis=1))
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (v * v[i]).sum(axis=1) / (size * size[i])
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def searched(frame, **more):
    out = collections.defaultdict(list)
    for r in neighbours.search(frame, **more).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def clouds(spark):
    """20,000 vectors around 150 centres of uneven weight, with a few far from all."""
    draw = np.random.default_rng(11)
    centre = draw.normal(size=(150, 32))
    own = np.minimum(draw.geometric(0.02, 20_000) - 1, 149)
    vectors = centre[own] + 0.6 * draw.normal(size=(20_000, 32))
    vectors[::997] = 40 * draw.normal(size=(len(vectors[::997]), 32))
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors.astype(np.float32).tolist())], "vec_id long, embedding array<float>")


@pytest.mark.parametrize("made, least", [(False, 0.95), (True, 0.9)])
def test_recall(spark, made, least):
    frame = clouds(spark) if made else spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [r for r in frame.collect() if any(r["embedding"])]
    want = brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    got = searched(frame)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= least * sum(map(len, want.values()))
    by_id = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    for q, found in got.items():
        for i, score in found:
            a, b = by_id[q], by_id[i]
            assert score == pytest.approx(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), abs=1e-14)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_small_tables_are_searched_whole(spark):
    """Copies, parallel and odd vectors, repeated ids; ties go to the smaller id."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in (0, 50, 7, 3, 100, 9, 12)] + [(i, [2.0, 0.0]) for i in (4, 150)] + [(200, [0.0, 1.0]), (200, [0.0, 1.0]), (11, [1.0, 1.0]), (13, [-1.0, 0.0])]
    bad = [(250, None), (300, [0.0, 0.0]), (350, [nan, 1.0]), (400, [inf, 1.0]), (450, [None, 1.0]), (500, [1.0]), (550, []), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "'x' as part", "1 as ids", "2 as vector", "3 as score", "4 as rank").repartition(3)
    got = searched(frame)
    assert [i for i, _ in got[0]] == [3, 4, 7, 9, 12] and {s for _, s in got[0]} == {1.0}
    assert [i for i, _ in got[50]] == [0, 3, 4, 7, 9] and [i for i, _ in got[150]] == [0, 3, 4, 7, 9]
    assert set(got) == {0, 50, 100, 150, 200}
    assert got[200][0] == (200, 1.0) and len(neighbours.search(frame).where("query_id = 200").collect()) >= 5


def test_few_or_no_candidates(spark):
    kind = "vec_id long, embedding array<float>"
    assert searched(spark.createDataFrame([(0, [1.0, 2.0])], kind)) == {}
    assert [i for i, _ in searched(spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.0])], kind))[0]] == [1]
    assert neighbours.search(spark.createDataFrame([], kind)).count() == 0


def test_many_copies_of_one_vector(spark):
    """A third of the rows share a vector: all ranks of its queries are its smallest ids."""
    random = np.random.default_rng(0)
    rows = [(i, [1.0] * 8 if i % 3 == 0 else random.normal(size=8).tolist()) for i in range(3000)]
    got = searched(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(8))
    assert [i for i, _ in got[150]] == [0, 3, 6, 9, 12] and [i for i, _ in got[0]] == [3, 6, 9, 12, 15]


def test_parts_are_balanced():
    random = np.random.default_rng(1)
    x = neighbours.unit(random.normal(size=(1500, 16)) + 3 * random.normal(size=(20, 16))[random.integers(0, 20, 1500)])
    graph = neighbours._graph(x, 10)
    part = neighbours.balanced_parts(graph, 10, random)
    size = np.bincount(part, minlength=10)
    assert size.max() <= 1.15 * 150 and size.min() >= 0.8 * 150
    assert (part[graph] == part[:, None]).mean() > 0.6


def test_queries_in_nearly_empty_parts_get_all_their_neighbours(spark, monkeypatch):
    """Parts that hold fewer candidates than asked for: the queries that visit them are searched in all parts."""
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(3000, 8))
    vectors[:, 0] = -abs(vectors[:, 0])
    vectors[[0, 50, 100], 0] = 30.0
    first, second = np.zeros((9, 1)), np.zeros((2, 2))
    first[0, 0], second[:, 1] = 1.0, (1000.0, -1.0)  # the second part has only those three
    monkeypatch.setattr(neighbours, "fit", lambda vectors, seed=3: neighbours.Router(first, second, 1))
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>").repartition(3)
    got, want = searched(frame), brute(range(3000), vectors.tolist())
    assert set(got) == set(want) and all(len(found) == 5 for found in got.values())
    assert {q: [i for i, _ in found] for q, found in got.items()} == {q: [i for i, _ in found] for q, found in want.items()}
