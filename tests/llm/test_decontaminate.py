"""Benchmark windows against a brute-force search."""

import hashlib
import re

import pytest

from grantlens.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, bench, width=10):
    windows = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        names = ",".join(sorted(map(str, items)))
        out.append((doc_id, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


BENCH = [(1, "lorem ipsum dolor"), (2, "LOREM ipsum, dolor sit amet lorem ipsum dolor sit amet lorem"), (3, None), (4, "..."), (5, "word"), (6, "end"), (6, "end"),
         (7, "for two ids one two three four five six seven"), (100, "it"), (20, "dé ß"), (30, "x" * 60_000)]


@pytest.mark.parametrize("block", [200_000, 40])
def test_documents(spark, folder, documents, texts, block):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    want = brute(texts, [(r["item_id"], r["text"]) for r in bench.collect()])
    assert rows(decontaminate.measure(documents, bench, block_pairs=block)) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [200_000, 3])
def test_odd(spark, odd, none, block):
    from .conftest import ODD

    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert rows(decontaminate.measure(odd, bench, block_pairs=block)) == sorted(brute(ODD, BENCH), key=repr)
    assert rows(decontaminate.measure(odd, bench.limit(0))) == sorted(brute(ODD, []), key=repr)
    assert decontaminate.measure(none, bench).count() == 0


def test_kept_columns(spark, odd):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontaminate.measure(odd, bench, keep=odd.columns)
    assert found.columns[:5] == odd.columns[:5] and found.schema["n_words"].dataType.simpleString() == "bigint"
    kept = decontaminate.clean(odd, bench)
    assert kept.schema == odd.schema
    from .conftest import ODD

    clean = [(d, t) for (d, t), b in zip(ODD, brute(ODD, BENCH)) if not b[5]]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_long_windows_and_lanes(spark):
    """Occurrences across the lanes of the search, and next to each other."""
    text = " ".join(f"w{i % 701}" for i in range(6000))
    bench = [(i, " ".join(f"w{(i * 37 + k) % 701}" for k in range(10))) for i in range(60)]
    docs = [(1, text), (2, text[:2000])]
    frame = decontaminate.measure(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert rows(frame) == sorted(brute(docs, bench), key=repr)
