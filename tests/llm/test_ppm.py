"""Prediction by partial matching against a plain implementation."""

import collections
import math
import re
import zlib

import pytest

from grantlens.llm import ppm

LOWER = {i: i + 32 for i in range(65, 91)}


def lowered(text):
    return (text or "").translate(LOWER)


def symbols(text):
    return [*lowered(text).encode(), 256]


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute(docs, order):
    trie, words, total = collections.defaultdict(collections.Counter), collections.Counter(), 0
    split = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", lowered(t)) if w]
    for doc_id, text in docs:
        if fold(doc_id) is False:
            s = symbols(text)
            padded = [257] * order + s
            for i in range(len(s)):
                for k in range(order + 1):
                    trie[tuple(padded[i + order - k:i + order])][s[i]] += 1
            words.update([*split(text), None])
    total = sum(words.values())
    out = []
    for doc_id, text in docs:
        s, score = symbols(text), 0.0
        padded = [257] * order + s
        for i, c in enumerate(s):
            gone = set()
            for k in range(order, -1, -1):
                seen = trie.get(tuple(padded[i + order - k:i + order]))
                if not seen:
                    continue
                left = {x: n for x, n in seen.items() if x not in gone}
                n, q = sum(left.values()), len(left)
                if c in left:
                    score += math.log10((left[c] - 0.5) / n)
                    break
                if q:
                    score += math.log10(q / (2 * n))
                gone |= set(seen)
            else:
                score -= math.log10(257 - len(gone))
        t = [*split(text), None]
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (len(words) + 1))) for w in t)
        out.append((doc_id, fold(doc_id), len(t), sum(words[w] > 0 for w in t), total, base, score))
    return out


def check(frame, want):
    got = sorted((tuple(r) for r in frame.collect()), key=lambda r: (repr(r[0]), r[2], r[6]))
    want = sorted(want, key=lambda r: (repr(r[0]), r[2], r[6]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-7, abs=1e-7)  # costs of runs are 32-bit numbers


@pytest.mark.parametrize("order, block", [(3, 12_000_000), (2, 3000), (5, 20_000)])
def test_documents(documents, texts, monkeypatch, order, block):
    monkeypatch.setattr(ppm, "BLOCK", block)
    monkeypatch.setattr(ppm, "CROWD", 3)  # several crowds of blocks are merged, and several answered
    monkeypatch.setattr(ppm, "MERGE", 500)
    docs = texts[:60]
    ids = {d for d, _ in docs}
    check(ppm.scores(documents.where(documents.doc_id.isin(ids)), order), brute(docs, order))


def test_odd(odd, none):
    from .conftest import ODD

    check(ppm.scores(odd, 3), brute(ODD, 3))
    assert ppm.scores(none).count() == 0


def test_nothing_to_learn_from(spark):
    held = [(i, "some text") for i in range(200) if fold(i)][:3]
    frame = spark.createDataFrame(held, "doc_id long, text string")
    check(ppm.scores(frame), brute(held, 5))
    assert {r["train_tokens"] for r in ppm.scores(frame).collect()} == {0}


def test_probabilities_sum_to_one():
    """All symbols after any context of a small trie."""
    docs = [(i, t) for i, t in enumerate(["abracadabra", "abba", "cab", "bad cab"]) if fold(i) is False] + [(2, "abracad")]
    for text in ("abra", "x", ""):
        total = 0.0
        for c in range(257):
            s = [*text.encode(), c]
            score = _next(docs, s)
            total += 10 ** score
        assert total == pytest.approx(1.0)


def _next(docs, s, order=3):
    import numpy as np

    trie = collections.defaultdict(collections.Counter)
    for _, text in docs:
        t = symbols(text)
        padded = [257] * order + t
        for i in range(len(t)):
            for k in range(order + 1):
                trie[tuple(padded[i + order - k:i + order])][t[i]] += 1
    code = lambda ctx, x: sum(y << (9 * i) for i, y in enumerate(reversed(ctx))) << 9 | x
    levels = [sorted((code(ctx, x), n) for ctx, seen in trie.items() if len(ctx) == k for x, n in seen.items()) for k in range(order + 1)]
    made = [tuple(np.array(x, np.int64) for x in zip(*level)) for level in levels]
    model = ppm.Trie(*made[order], made[:2], order)
    for level, (codes, counts) in zip(model.levels, made):
        assert level.codes.tolist() == codes.tolist() and level.counts.tolist() == counts.tolist()
    padded = [257] * order + s
    return float(model.log10(np.array([code(padded[-order - 1:-1], s[-1])]))[0])


def test_held_out_texts_are_better_predicted_than_by_words(spark):
    """On a corpus of some size the model beats the unigram base."""
    rows = ppm.scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert rows["s"] > rows["b"]
