"""Benchmark decontamination by Wu-Manber search over words.

A test string is a window of consecutive benchmark words. Symbols are words (by fingerprint), blocks are pairs of words:
the shift table of a window length tells for a block how many words the search may skip, a zero shift leads to
the windows that end with that block (bucket by suffix, narrowed by the window's own fingerprint), and the words
themselves are compared before an occurrence counts. Windows of items shorter than a window have searches of their own.

Windows are collected in blocks of at most BLOCK_PAIRS (window, item) pairs, so what is broadcast has a fixed bound;
a larger benchmark takes several passes whose hits are joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import frugal, joined_bytes, shared, slices, staged

WIDTH = 10
BLOCK_PAIRS = 200_000
LANE = 512  # words that one cursor of the search walks over
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def windows(bench: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (item_id, window, n_words) of all items; a window's words are joined by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 200_000):
            data, marks = joined_bytes(part.column("text"))
            data = W.LOWER[data]
            starts, ends, at = W.bounds(data, marks, W.ALPHANUMERIC)
            raw = data.tobytes()
            found = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            items, out, sizes = [], [], []
            for item, a, b in zip(part.column("item_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                for i in range(a, max(b - width, a) + 1 if b > a else a):
                    chosen = found[i:min(i + width, b)]
                    items.append(item)
                    out.append(b" ".join(chosen).decode("utf-8", "replace"))
                    sizes.append(len(chosen))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(out, pa.string()), pa.array(sizes, pa.int32())],
                                             ["item_id", "window", "n_words"])

    read = bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    return read.mapInArrow(cut, "item_id long, window string, n_words int").distinct()


class Search:
    """Wu-Manber tables for windows of one length, in words."""

    def __init__(self, found: list[bytes], numbers: list[int], width: int):
        self.width, self.block = width, min(2, width)
        split = [w.split(b" ") for w in found]
        data = np.frombuffer(b"".join(b"".join(s) for s in split), np.uint8)
        size = np.array([len(w) for s in split for w in s], np.int64)
        ends = np.cumsum(size)
        prints = W.fingerprints(data, ends - size, ends).reshape(len(found), width)
        whole = W.mixed(_fold(prints))
        order = np.argsort(whole, kind="stable")
        self.whole, self.texts, self.numbers = whole[order], [found[i] for i in order], np.array(numbers, np.int64)[order]
        bits = max(10, int(np.ceil(np.log2(4 * prints.size + 1))))
        self.bits = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, width - self.block + 1, np.uint8 if width < 255 else np.uint32)
        for i in range(self.block - 1, width):
            slot = self._slot(prints[:, i - self.block + 1:i + 1])
            np.minimum.at(self.shift, slot, width - 1 - i)

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return (W.mixed(_fold(blocks)) >> self.bits).astype(np.int64)

    def occurrences(self, prints: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of places whose fingerprints agree. Lanes of the text are walked side by side."""
        m = self.width
        size = np.diff(marks)
        lanes = np.where(size >= m, -(-(size - m + 1) // LANE), 0)
        doc = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = marks[doc] + nth * LANE + m - 1  # the word under the window's end
        stop = np.minimum(marks[doc] + (nth + 1) * LANE + m - 1, marks[doc + 1])
        hits = []
        while len(at):
            skip = self.shift[self._slot(np.stack([prints[at - i] for i in range(self.block - 1, -1, -1)], axis=1))]
            here = at[skip == 0]
            if len(here):
                hits.append(here)
            at = at + np.maximum(skip, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end = np.concatenate(hits)
        span = W.mixed(_fold(np.stack([prints[end - i] for i in range(m - 1, -1, -1)], axis=1)))
        first, last = np.searchsorted(self.whole, span, "left"), np.searchsorted(self.whole, span, "right")
        n = last - first
        return np.repeat(end - m + 1, n), W.ranges(first, n)


def _fold(blocks: np.ndarray) -> np.ndarray:
    out = np.zeros(len(blocks), np.uint64)
    for column in blocks.T:
        out = out * np.uint64(0x9E3779B97F4A7C15) + column
    return out


class Matcher:
    """All windows of a block: a search for each length, and the items of each window."""

    def __init__(self, rows: list[tuple[int, str, int]]):
        by_window: dict[str, list[int]] = {}
        width: dict[str, int] = {}
        for item, window, n in rows:
            by_window.setdefault(window, []).append(item)
            width[window] = n
        texts = list(by_window)
        self.items = [np.array(sorted(by_window[t]), np.int64) for t in texts]
        lengths: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            lengths.setdefault(width[t], []).append(i)
        self.searches = [Search([texts[i].encode() for i in chosen], chosen, n) for n, chosen in sorted(lengths.items())]

    def hits(self, data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Words per text, and for each text its hit spans (pairs of word numbers) and items."""
        data = W.LOWER[data]
        starts, ends, at = W.bounds(data, marks, W.ALPHANUMERIC)
        n_words = np.diff(at)
        none = (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
        out = [none] * len(n_words)
        if not len(starts) or not self.searches:
            return n_words, out
        prints = W.fingerprints(data, starts, ends)
        raw = data.tobytes()
        first, length, window = [], [], []
        for search in self.searches:
            where, which = search.occurrences(prints, at)
            same = [b" ".join(raw[starts[k]:ends[k]] for k in range(p, p + search.width)) == search.texts[w]
                    for p, w in zip(where.tolist(), which.tolist())]  # the words themselves
            keep = np.array(same, bool)
            first.append(where[keep])
            window.append(search.numbers[which[keep]])
            length.append(np.full(keep.sum(), search.width))
        first, length, window = map(np.concatenate, (first, length, window))
        if not len(first):
            return n_words, out
        doc = np.searchsorted(at, first, "right") - 1
        order = np.argsort(doc, kind="stable")
        doc, first, length, window = doc[order], first[order], length[order], window[order]
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for group in np.split(np.arange(len(doc)), cuts):
            d = doc[group[0]]
            spans = np.stack([first[group] - at[d], first[group] - at[d] + length[group]], axis=1)
            out[d] = spans, np.unique(np.concatenate([self.items[w] for w in np.unique(window[group])]))
        return n_words, out


def _summary(n_words: int, spans: np.ndarray, items: np.ndarray) -> tuple[int, int, int, str, bool]:
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    n_hit = int((np.cumsum(edge)[:-1] > 0).sum())
    names = ",".join(sorted(map(str, items.tolist())))
    return n_words, n_hit, len(items), hashlib.sha256(names.encode()).hexdigest(), n_hit > 0


_EMPTY = hashlib.sha256(b"").hexdigest()


def _with_summaries(batch: pa.RecordBatch, keep: list[str], found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in keep] + [pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
        keep + NAMES)


def measure(docs: DataFrame, bench: DataFrame, width: int = WIDTH, keep: list[str] | None = None, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Columns `keep` of each document (default doc_id), then n_words, n_hit, n_items, items_sha256, contaminated.

    Null and wordless texts have no words and no hits; each row counts by itself, so repeated rows repeat their result.
    A kept column with the name of a result gives way to it. Without benchmark words nothing is hit.
    """
    keep = [c for c in (keep if keep is not None else ["doc_id"]) if c not in NAMES]
    pairs = staged(windows(bench, width))
    total = pairs.count()
    if total > block_pairs:
        return _in_blocks(docs, pairs, -(-total // block_pairs), keep)
    matcher = shared(docs.sparkSession, Matcher([tuple(r) for r in pairs.select("item_id", "window", "n_words").collect()]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n_words, found = matcher().hits(*joined_bytes(part.column("text")))
            yield _with_summaries(part, keep, [_summary(n, *f) if len(f[1]) else (n, 0, 0, _EMPTY, False) for n, f in zip(n_words.tolist(), found)])

    return docs.select(*{*keep, "text"}).mapInArrow(frugal(search), _schema(docs, keep))


def _schema(docs: DataFrame, keep: list[str]) -> str:
    return ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), RESULT])


def _in_blocks(docs: DataFrame, pairs: DataFrame, blocks: int, keep: list[str]) -> DataFrame:
    """One pass over the texts for each block of windows; hits of all passes are joined by row."""
    spark = docs.sparkSession
    rows = staged(docs.select(*{*keep, "text"}).withColumn("_row", F.monotonically_increasing_id()))
    parts = []
    for block in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == block)
        matcher = shared(spark, Matcher([tuple(r) for r in mine.select("item_id", "window", "n_words").collect()]))

        def search(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                _, found = matcher().hits(*joined_bytes(part.column("text")))
                some = [i for i, f in enumerate(found) if len(f[1])]
                yield pa.RecordBatch.from_arrays([part.column("_row").take(pa.array(some, pa.int64())),
                                                  pa.array([found[i][0].ravel().tolist() for i in some], pa.list_(pa.int64())),
                                                  pa.array([found[i][1].tolist() for i in some], pa.list_(pa.int64()))], ["_row", "spans", "items"])

        parts.append(rows.select("_row", "text").mapInArrow(search, "_row long, spans array<long>, items array<long>"))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    merged = staged(union).groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                               F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, marks = joined_bytes(part.column("text"))
            n_words = np.diff(W.bounds(W.LOWER[data], marks, W.ALPHANUMERIC)[2])
            found = [_summary(n, np.array(s, np.int64).reshape(-1, 2), np.array(i, np.int64)) if i else (n, 0, 0, _EMPTY, False)
                     for n, s, i in zip(n_words.tolist(), part.column("_spans").to_pylist(), part.column("_items").to_pylist())]
            yield _with_summaries(part, keep, found)

    joined = rows.join(merged.select("_row", F.col("spans").alias("_spans"), F.col("items").alias("_items")), "_row", "left")
    return joined.select(*{*keep, "text"}, "_spans", "_items").mapInArrow(finish, _schema(docs, keep))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents without any occurrence of a benchmark window, with all their columns."""
    named = {c: f"_{i}" for i, c in enumerate(docs.columns) if c != "text"}  # result names cannot clash
    renamed = docs.select(*(F.col(f"`{c}`").alias(named.get(c, c)) for c in docs.columns))
    kept = measure(renamed, bench, keep=[named.get(c, c) for c in docs.columns]).where(~F.col("contaminated"))
    return kept.select(*(F.col(named.get(c, c)).alias(c) for c in docs.columns))
