"""The Merkle manifest: a plain tree in memory, versions that share nodes, odd rows."""

import hashlib
import zlib

import pytest

from grantlens.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def siblings(levels, at, arity):
    out = []
    for nodes in levels[:-1]:
        first = at // arity * arity
        out.append((nodes[first:at], nodes[at + 1:first + arity]))
        at //= arity
    return out


def brute(rows, arity=3):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in order[s]], arity) for s in sources}
    top = tree([trees[s][-1][0] for s in sources], arity)
    out, copies = [], []
    for k, s in enumerate(sources):
        for i, r in enumerate(order[s]):
            steps = siblings(trees[s], i, arity) + siblings(top, k, arity)
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            changed = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else leaf(r)
            node, made = changed, [changed]
            for a, b in steps:
                node = H(*a, node, *b)
                made.append(node)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], H(*[x for a, b in steps for x in a + b]), node, node == top[-1][0]))
            if changed != leaf(r):
                copies += [(r[0], s, h, x) for h, x in enumerate(made)]
    return sorted(out, key=str), sorted(copies, key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_documents(spark, documents):
    want, _ = brute([tuple(r[c] for c in COLUMNS) for r in documents.collect()])
    got = rows_of(merkle.manifest(documents))
    assert got == want
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("arity, levels", [(3, 2), (2, 2)])
def test_many_tiers(spark, arity, levels):
    """Blocks far smaller than the trees: a hot source, small ones, and many sources with one row."""
    rows = [(i, "hot", "en", i, f"line {i}\nline") for i in range(200)] + [(i, f"s{i}", None, None, "x\ny") for i in range(300, 340)]
    rows += [(i, None, "de", 1, None) for i in range(400, 404)] + [(i, "s2", "de", 1, "\n") for i in range(500, 510)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    want, copies = brute(rows, arity)
    assert rows_of(merkle.manifest(frame, arity, levels)) == want
    assert rows_of(merkle.versions(frame, arity, levels)) == copies


def test_odd_rows(spark, odd, none):
    rows = [tuple(r[c] for c in COLUMNS) for r in odd.collect()]
    clash = odd.selectExpr("*", "'x' as tree", "1 as at", "2 as size", "'y' as hash", "'z' as leaf", "3 as changed", "4 as path").drop("block")
    assert rows_of(merkle.manifest(clash)) == brute(rows)[0]
    assert rows_of(merkle.manifest(odd.limit(1))) == brute([tuple(r[c] for c in COLUMNS) for r in odd.limit(1).collect()])[0]
    assert merkle.manifest(none).collect() == [] and merkle.versions(none).collect() == []


def test_versions_share_all_but_the_ancestors():
    nodes = [H(str(i)) for i in range(100)]
    block = merkle.Block(nodes, True, 3, 7)
    levels = tree(nodes, 3)
    assert block.levels == levels
    for i in (0, 41, 99):
        changed = nodes[:i] + ["new"] + nodes[i + 1:]
        other = tree(changed, 3)
        new = merkle.copied("new", block.path(i))
        at = i
        for height, made in enumerate(new, 1):
            at //= 3
            assert other[height][at] == made
            assert other[height][:at] == levels[height][:at] and other[height][at + 1:] == levels[height][at + 1:]
