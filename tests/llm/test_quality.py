"""The quality classifier: coverage of whole texts, folds, and held-out accuracy."""

import zlib

import numpy as np

from grantlens.llm import quality


def labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = quality.assess(spark.read.parquet(f"{folder}/documents.parquet"), labels(spark, folder)).join(labels(spark, folder), "doc_id").toPandas()
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() > 0.98
    assert held[held.quality == 1].predicted.mean() > 0.98
    assert held[held.quality == 0].predicted.mean() < 0.1
    assert (scored.held_out == scored.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    assert ((scored.score >= 0.7) == (scored.predicted == 1)).all()


def test_held_out_labels_are_not_used(spark, folder, documents):
    """Turning the held-out labels round changes no score."""
    own = labels(spark, folder)
    turned = own.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a = {r["doc_id"]: r["score"] for r in quality.assess(documents, own).collect()}
    assert a == {r["doc_id"]: r["score"] for r in quality.assess(documents, turned).collect()}


def test_chunks_cover_every_byte():
    for n in (0, 1, 63, 64, 65, 1023, 1024, 1025, 1984, 1985, 5000):
        data = np.arange(n, dtype=np.int64).astype(np.uint8)
        symbols, doc = quality.chunked(data, np.array([0, n]))
        held = np.concatenate([symbols[i, :max(0, min(quality.CHUNK, n - i * quality.STEP))] & 255 for i in range(len(symbols))]) if n else []
        seen = np.zeros(n, bool)
        for i in range(len(symbols)):
            seen[i * quality.STEP:i * quality.STEP + quality.CHUNK] = True
        assert seen.all() and len(symbols) >= 1 and len(held) >= n


def test_repetition_inside_reach():
    text = b"alpha alpha beta gamma " + b"x" * 30
    symbols, _ = quality.chunked(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    marked = (symbols[0] >> 8).astype(bool)
    grams = [text[i:i + 4].ljust(4, b"\0") for i in range(len(text))]
    want = [any(grams[i] == grams[j] for j in range(max(0, i - quality.REACH), i - 1)) for i in range(len(text))]
    assert marked[:len(text) - 3].tolist() == want[:len(text) - 3]


def test_the_end_of_a_long_text_counts(spark, folder, documents):
    """Junk behind a long clean beginning changes the score."""
    net = quality.train(documents, labels(spark, folder))
    clean = documents.join(labels(spark, folder).where("quality = 1"), "doc_id").first()["text"]
    docs = spark.createDataFrame([(1, clean * 20), (2, clean * 20 + "| %%% $$$ | &&& " * 3000)], "doc_id long, text string")
    a, b = (r["score"] for r in quality.score(docs, net).orderBy("doc_id").collect())
    assert a > b


def test_odd(spark, folder, odd, none):
    from .conftest import ODD

    rows = quality.assess(odd, labels(spark, folder)).collect()
    assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(d) for d, _ in ODD)
    assert all(0 <= r["score"] <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert by[1] == by[2] and by[6] == by[7] and len(by[8]) == 1
    assert quality.assess(none, labels(spark, folder)).count() == 0
    assert quality.accepted(odd, labels(spark, folder)).schema == odd.schema


def test_without_usable_labels(spark, odd):
    trained = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2 and i in (4, 5, 6, 7, 9, 10))
    for rows, want in (([], 0.5), ([(trained, 1), (None, 1), (11, None)], 2 / 3)):
        given = spark.createDataFrame(rows, "doc_id long, quality int")
        assert {round(r["score"], 9) for r in quality.assess(odd, given).collect()} == {round(want, 9)}
