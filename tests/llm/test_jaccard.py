"""Near duplicates against brute force, with groups dealt into blocks of several sizes."""

import collections
import random
import re

import pytest

from grantlens.llm import jaccard
from grantlens.llm.components import connected

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, percent=75):
    """Rows (doc_id, n_shingles, component_id) of all documents."""
    sets = [(d, shingles(t)) for d, t in docs]
    above = list(range(len(docs)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    lists = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        common = collections.Counter()
        for x in s:
            common.update(lists[x])
            lists[x].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                above[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i))) for i, (d, s) in enumerate(sets)), key=repr)


def found(frame, *more):
    return sorted((tuple(r) for r in jaccard.components(frame, *more).collect()), key=repr)


@pytest.mark.parametrize("group", [512, 3])
def test_documents(documents, texts, group):
    assert found(documents, group) == brute(texts)


@pytest.mark.parametrize("group", [512, 2])
def test_odd(odd, none, group):
    from .conftest import ODD

    # Rows with one id and one text are one document.
    assert sorted(set(found(odd, group)), key=repr) == sorted(set(brute(ODD)), key=repr)
    assert jaccard.components(none).count() == 0 and jaccard.one_of_each(none).count() == 0


@pytest.mark.parametrize("group", [512, 20, 5])
def test_one_large_group_and_sizes_at_the_limit(spark, group):
    """Near copies of one text that do not all link with each other, chains, and short texts around every limit."""
    random.seed(8)
    words = [f"w{i}" for i in range(400)]
    base = [random.choice(words) for _ in range(80)]
    docs, n = [], 0

    def add(w):
        nonlocal n
        n += 1
        docs.append((n, " ".join(w)))

    for _ in range(150):
        w = list(base)
        for _ in range(random.randint(0, 4)):
            w[random.randrange(len(w))] = random.choice(words) + "x"
        add(w)
    chain = [random.choice(words) + "y" for _ in range(60)]
    for i in range(40):
        add(chain[i:] + [f"z{i}{k}" for k in range(i)])
    for size in range(1, 26):
        start = [f"s{size}_{k}" for k in range(size)]
        add(start)
        add(start + ["tail"])
        add(start + ["tail", "tail2"])
        add(start[:-1] + ["other"])
        add(start + start)
    random.shuffle(docs)
    assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), group) == brute(docs)


def test_signatures_meet_whatever_the_boundary():
    """Any two sets at the threshold share a key, wherever the boundary between light and heavy is."""
    import numpy as np

    random.seed(2)
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = random.randint(2, 60)
        a = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
        more = random.randint(0, n // 3)
        b = np.concatenate([a[random.randint(0, n // 4):], rng.choice(1 << 40, more, replace=False).astype(np.uint64) + np.uint64(1 << 41)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if 100 * common < 75 * (len(a) + len(b) - common) or (len(a) == len(b) == common):
            continue
        uses = {x: (2 if x in set(b.tolist()) else 1) + random.randint(0, 3) * (x in set(b.tolist())) for x in a.tolist()}
        uses |= {x: 1 for x in b.tolist() if x not in uses}
        for light in (0, 5, 20, 45, 200):
            ka, kb = (set(jaccard._first_keys(s, np.array([uses[x] for x in s.tolist()]), light).tolist()) for s in (a, b))
            assert ka & kb, (len(a), len(b), common, light)


def test_one_of_each(documents, texts, odd):
    want = {c for _, _, c in brute(texts)}
    kept = jaccard.one_of_each(documents)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert kept.schema.names == documents.columns
    rows = jaccard.one_of_each(odd)
    assert sorted(rows.columns) == sorted(odd.columns)
    ids = [r["doc_id"] for r in rows.collect()]
    assert ids.count(8) == 1 and ids.count(None) == 1 and 6 in ids and 7 not in ids


def test_one_of_each_tells_texts_under_one_id_apart(spark):
    """A row is judged by its own text: copies go, whatever id they share, and a text that nobody else has stays."""
    same, other = "one text that two rows have in common here", "a text of its own under the id of a copy"
    docs = [(1, same), (2, same), (2, other), (3, other.upper()), (4, None), (4, ""), (4, "  "), (4, "  "), (5, "five words make one shingle"), (None, same), (None, "nobody has this text or any id")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in jaccard.one_of_each(frame).collect()), key=repr)
    # Null and empty text under one id are the same document without words.
    assert [g for g in got if g[0] != 4] == sorted([(1, same), (2, other), (5, docs[8][1]), (None, docs[10][1])], key=repr)
    assert len([g for g in got if g[0] == 4]) == 2


def test_connected(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)] + [(2000, 2001 + i) for i in range(50)]
    above = {}
    find = lambda x: x if above.setdefault(x, x) == x else find(above[x])
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            above[b] = a
    got = {r["node"]: r["part"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in above}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies():
    """Rows of one large group, where most pairs link, with copies under other ids, under one id and without an id, and a chain."""
    random.seed(12)
    words = [f"w{i}" for i in range(300)]
    base = [random.choice(words) for _ in range(70)]
    docs = []
    for i in range(90):
        w = list(base)
        for _ in range(random.randint(0, 3)):
            w[random.randrange(len(w))] = f"x{i}"
        docs += [(len(docs) + k, " ".join(w)) for k in range(random.choice((1, 1, 1, 3)))]
    chain = [random.choice(words) + "y" for _ in range(60)]
    docs += [(1000 + i, " ".join(chain[i:] + [f"z{i}{k}" for k in range(i)])) for i in range(25)]
    return docs + [docs[0], (None, docs[1][1]), (2000, None), (2001, ""), (2002, "alone with itself and nobody else around")]


def brute_links(docs):
    sets = [shingles(t) for _, t in docs]
    return [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])], sets


@pytest.mark.parametrize("group", [512, 20, 5])
def test_every_link(spark, group):
    """Each linked pair of different texts comes once, and each row counts all that it links with."""
    docs = near_copies()
    pairs, sets = brute_links(docs)
    degree = collections.Counter(i for pair in pairs for i in pair)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted(((r["doc_id"], r["n_links"]) for r in jaccard.linked(frame, group).collect()), key=repr)
    assert got == sorted(((d, degree[i]) for i, (d, _) in enumerate(docs)), key=repr)
    rows = [(r["class"], r["other"]) for r in jaccard.links(frame, group).collect()]
    assert len(rows) == len(set(rows)) and all(a < b for a, b in rows)
    by_name = {r["class"]: r["doc_id"] for r in jaccard.classes(jaccard.in_blocks(frame.selectExpr("*", "md5(text) AS mark"), 1000)).where("doc_id IS NOT NULL").collect()}
    of_id = {d: s for (d, _), s in zip(docs, sets)}
    want = {frozenset((sets[i], sets[j])) for i, j in pairs if sets[i] != sets[j]}
    assert {frozenset((of_id[by_name[a]], of_id[by_name[b]])) for a, b in rows} == want and len(rows) == len(want)


def test_sets_visit_only_blocks_that_hold_their_keys(spark):
    """A group tied by a chain of shared keys ships each set a few times, however many blocks it has."""
    rows = [(f"c{i:03}", 8, bytes(8 * 8), [i, i + 1]) for i in range(200)]
    candidates = spark.createDataFrame(rows, "class string, n long, found binary, keys array<long>")
    sizes = spark.createDataFrame([(r[0], 1) for r in rows], "class string, rows long")
    met = collections.defaultdict(set)
    for r in jaccard.meetings(candidates, sizes, 10).collect():
        met[r["group"], r["low"], r["high"]].add(r["class"])
    assert sum(map(len, met.values())) <= 3 * len(rows)
    assert all(any({a[0], b[0]} <= m for m in met.values()) for a, b in zip(rows, rows[1:]))
