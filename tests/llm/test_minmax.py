"""Near duplicates by min-max hashing: components against brute force, signatures, keys of very many classes."""

import random

import numpy as np
import pytest

from grantlens.llm import minmax

from .test_jaccard import brute, near_copies


def want(docs):
    return sorted(((d, n, c, None if d is None or c is None else d == c) for d, n, c in brute(docs, 85)), key=repr)


def found(frame, *more):
    return sorted((tuple(r) for r in minmax.near_duplicates(frame, *more).collect()), key=repr)


def test_documents(documents, texts):
    assert found(documents) == want(texts)


def test_odd(odd, none):
    from .conftest import ODD

    got = found(odd)
    assert got == want(ODD) and sum(1 for r in got if r[3]) > 8
    assert found(none) == []


@pytest.mark.parametrize("group", [512, 6])
def test_groups_and_sizes_at_the_limit(spark, group):
    """Near copies, a chain whose ends are unlike each other, and short texts around every limit."""
    random.seed(4)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, t) for i, t in near_copies()]
    chain = [random.choice(words) + "q" for _ in range(90)]
    docs += [(3000 + i, " ".join(chain[i:] + [f"z{i}{k}" for k in range(i)])) for i in range(40)]
    for size in range(5, 30):
        start = [f"s{size}_{k}" for k in range(size)]
        for k, w in enumerate((start, start + ["tail"], start + ["tail", "tail2"], start[:-1] + ["other"], start + start)):
            docs.append((5000 + 10 * size + k, " ".join(w)))
    random.shuffle(docs)
    assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), group) == want(docs)


def test_a_key_whose_members_do_not_link_with_its_smallest_class(spark):
    """Families around one passage: each is linked within, none with another, and all share keys when bands are made weak."""
    random.seed(9)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for family in range(8):
        tail = [f"t{family}_{i}" for i in range(30)]
        for k in range(5):
            docs.append((len(docs), " ".join(passage + tail[:30 - k % 2] + [f"x{family}"])))
            docs.append((len(docs), " ".join(passage + tail + [f"x{family}", f"y{k}"])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    blocks = minmax.in_blocks(frame, 2000)
    weak = minmax.signed(blocks, 4, 1).where("class IS NOT NULL")  # four bands of one permutation
    classes = minmax.stored(weak.groupBy("class").agg(minmax.F.min("doc_id").alias("first"), minmax.F.min(minmax.F.struct("block", "n_shingles", "bands")).alias("one"))
                            .select("class", "first", "one.block", minmax.F.col("one.n_shingles").alias("n"), "one.bands"))
    edges = [(bytes(r["a"]), bytes(r["b"])) for r in minmax.confirmed_links(blocks, classes, 4).collect()]
    ids = {bytes(r["class"]): r["first"] for r in classes.collect()}
    above = {i: i for i in ids.values()}
    top = lambda i: i if above[i] == i else top(above[i])
    for a, b in edges:
        a, b = sorted((top(ids[a]), top(ids[b])))
        above[b] = a
    least = {d: c for d, _, c in brute(docs, 85)}
    assert {i: top(i) for i in above} == {i: least[i] for i in above}


def test_signatures_estimate_similarity():
    """Both halves of a permutation agree as often as the sets are similar, and together vary less than minima alone."""
    draw = np.random.default_rng(1)
    errors = []
    for similarity in (0.5, 0.85, 0.95):
        n = 400
        common = draw.integers(0, 1 << 64, round(2 * n * similarity / (1 + similarity)), np.uint64)
        a, b = (np.unique(np.concatenate([common, draw.integers(0, 1 << 64, n - len(common), np.uint64)])) for _ in "ab")
        s = minmax.signatures([a, b], 2000)
        assert s.shape == (2, 2000, 2)
        for part in (s[:, :, 0], s[:, :, 1], s.reshape(2, -1)):
            errors.append(abs((part[0] == part[1]).mean() - similarity))
    assert max(errors) < 0.04


def test_sets_at_the_threshold_share_a_key():
    draw = np.random.default_rng(2)
    sets = []
    for n in (20, 37, 100, 1000):
        for _ in range(100):
            union = draw.integers(0, 1 << 64, n, np.uint64)
            common = -(-85 * n // 100)
            left = common + (n - common) // 2
            sets += [np.unique(union[:left]), np.unique(np.concatenate([union[:common], union[left:]]))]
    keys = minmax.band_keys(minmax.signatures(sets, minmax.BANDS * minmax.PERMUTATIONS), minmax.BANDS)
    assert (keys[0::2] == keys[1::2]).any(axis=1).all()
