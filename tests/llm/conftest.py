import os

import pytest

DATA = os.environ.get("GRANTLENS_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


# Null ids and texts, empty, blank and one-word texts, copies under one id and under several, long texts with and without spaces.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "four words only here"), (6, "The same text, for two ids: one two three four five six seven."),
    (7, "The same text, for two ids: one two three four five six seven."), (8, "repeated row with its id and nine more words in it"),
    (8, "repeated row with its id and nine more words in it"), (None, "a document without an id but with enough words to make shingles"),
    (9, "x" * 60_000), (10, "lorem ipsum dolor sit amet " * 4_000), (11, "Ünï ço dé ß 😀 12 a@b.co 1.2.3.4 \u0000 　 end"), (-50, "negative id"),
]
CLASHES = ("score", "predicted", "n_words", "n_hit", "contaminated", "component_id", "class", "chunk", "found", "keys", "spans", "_spans", "_row", "start", "piece",
           "length", "rank", "shard", "block", "held_out", "key", "n_tokens", "page_id", "host", "path", "part", "vector", "ids", "_kept", "first")


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with columns that operators use inside or return."""
    frame = spark.createDataFrame([(i, t, "en" if t else None, None, len(t) if t else None, *["x"] * len(CLASHES)) for i, t in ODD],
                                  "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    return frame.repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
