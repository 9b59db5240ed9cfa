"""Text quality by a byte-level convolutional network in numpy.

Symbols are bytes, told apart by whether the four bytes from there on occurred in the REACH bytes before (so that
filters see stuttering). A text is cut into overlapping chunks that cover all of it. Each learned filter looks at WIDTH
neighbouring symbols, is rectified, and its largest value in a chunk is kept; the mean of these over all chunks
gives one probability. Training uses at most SAMPLE labelled documents, chosen by a hash of their ids, and at
most SAMPLE_CHUNKS evenly spread chunks of each; scoring always covers whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, joined_bytes, shared, slices

CHUNK, STEP = 1024, 960
WIDTH, FILTERS, REACH = 5, 12, 40
SAMPLE, SAMPLE_CHUNKS = 4000, 16
EPOCHS, STEPS, BATCH, RATE = 8, 400, 64, 0.01  # passes over the sample, and updates at least
AT_ONCE = 128  # chunks that one step scores


@dataclass
class Network:
    tables: np.ndarray  # [WIDTH, 512, FILTERS]
    floor: np.ndarray  # of each filter
    weights: np.ndarray
    bias: float

    def filtered(self, symbols: np.ndarray) -> np.ndarray:
        """[chunks, CHUNK] symbols to [chunks, positions, FILTERS]."""
        n = symbols.shape[1] - WIDTH + 1
        out = self.tables[0][symbols[:, :n]]
        for j in range(1, WIDTH):
            out += self.tables[j][symbols[:, j:j + n]]
        return out

    def pooled(self, symbols: np.ndarray) -> np.ndarray:
        out = np.empty((len(symbols), FILTERS), np.float32)
        for at in range(0, len(symbols), AT_ONCE):
            out[at:at + AT_ONCE] = self.filtered(symbols[at:at + AT_ONCE]).max(axis=1)
        return np.maximum(out + self.floor, 0)

    def scores(self, symbols: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        kept = self.pooled(symbols)
        mean = np.zeros((docs, FILTERS))
        np.add.at(mean, doc, kept)
        mean /= np.bincount(doc, minlength=docs)[:, None]
        return 1 / (1 + np.exp(-np.clip(mean @ self.weights + self.bias, -30, 30)))


def chunked(data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all chunks of all texts, and the text of each chunk. An empty text has one empty chunk."""
    size = np.diff(marks)
    n = np.maximum(1, -(-(size - (CHUNK - STEP)) // STEP))
    doc = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = marks[doc] + nth * STEP
    place = first[:, None] + np.arange(CHUNK)
    padded = np.concatenate([data, np.zeros(CHUNK + 4, np.uint8)])
    symbols = np.where(place < marks[doc + 1][:, None], padded[np.minimum(place, len(data))], 0).astype(np.uint16)
    return symbols + (again(symbols).astype(np.uint16) << 8), doc


def again(symbols: np.ndarray) -> np.ndarray:
    """Whether four bytes from here on also stand somewhere in the REACH bytes before, inside the chunk."""
    wide = np.zeros((len(symbols), CHUNK + 3), np.uint32)
    wide[:, :CHUNK] = symbols
    grams = wide[:, :CHUNK] | wide[:, 1:CHUNK + 1] << 8 | wide[:, 2:CHUNK + 2] << 16 | wide[:, 3:] << 24
    out = np.zeros((len(symbols), CHUNK), bool)
    for lag in range(2, REACH + 1):
        out[:, lag:] |= grams[:, lag:] == grams[:, :-lag]
    out &= grams != 0  # padding
    return out


def fit(cuts: list[list[bytes]], labels: np.ndarray, seed: int = 7) -> Network:
    """Train on documents given as lists of chunks (Adam on the log loss; classes count the same)."""
    random = np.random.default_rng(seed)
    net = Network((random.normal(0, 0.05, (WIDTH, 512, FILTERS))).astype(np.float32), np.zeros(FILTERS, np.float32),
                  random.normal(0, 0.3, FILTERS), 0.0)
    ones = int(labels.sum())
    if not len(labels) or ones in (0, len(labels)):
        net.weights[:] = 0
        net.bias = float(np.log((ones + 1) / (len(labels) - ones + 1)))
        return net
    flat = [c for doc in cuts for c in doc]
    symbols = np.zeros((len(flat), CHUNK), np.uint16)
    for at in range(0, len(flat), AT_ONCE):
        some = flat[at:at + AT_ONCE]
        marks = np.concatenate(([0], np.cumsum([len(c) for c in some])))
        symbols[at:at + AT_ONCE] = chunked(np.frombuffer(b"".join(some), np.uint8), marks)[0]
    of = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
    first = np.searchsorted(of, np.arange(len(cuts) + 1))
    weight = np.where(labels == 1, 0.5 / ones, 0.5 / (len(labels) - ones)) * len(labels)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.tables, net.floor, net.weights, np.zeros(1))]
    bias, step = np.zeros(1), 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(cuts)))):
        order = random.permutation(len(cuts))
        for at in range(0, len(order), BATCH):
            docs = order[at:at + BATCH]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), first[docs + 1] - first[docs])
            x = symbols[rows]
            response = net.filtered(x)
            where = response.argmax(axis=1)
            top = np.take_along_axis(response, where[:, None, :], 1)[:, 0] + net.floor
            kept = np.maximum(top, 0)
            n = np.bincount(own, minlength=len(docs))[:, None]
            mean = np.zeros((len(docs), FILTERS))
            np.add.at(mean, own, kept)
            mean /= n
            guess = 1 / (1 + np.exp(-np.clip(mean @ net.weights + bias[0], -30, 30)))
            error = (guess - labels[docs]) * weight[docs] / len(docs)
            down = (error[:, None] * net.weights / n)[own] * (top > 0)
            steps = [np.zeros_like(net.tables), down.sum(axis=0), mean.T @ error + 1e-4 * net.weights, np.array([error.sum()])]
            filters = np.broadcast_to(np.arange(FILTERS), where.shape)
            for j in range(WIDTH):
                np.add.at(steps[0][j], (np.take_along_axis(x, where + j, 1), filters), down)
            step += 1
            for p, g, (m, v) in zip((net.tables, net.floor, net.weights, bias), steps, state):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(p.dtype)
    net.bias = float(bias[0])
    return net


def remainder(doc_id: str) -> Column:
    """Which of four folds a document is in; fold 2 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit on at most SAMPLE labelled documents outside fold 2. Rows with a null label or id are not used."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id IS NOT NULL AND quality IS NOT NULL").where(remainder("doc_id") != 2)
    chosen = {r["doc_id"]: r["quality"] for r in usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE).collect()}
    spark = docs.sparkSession
    ids = spark.createDataFrame([(d,) for d in chosen], "doc_id long")  # SAMPLE rows at most

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, marks = joined_bytes(part.column("text"))
            cuts = []
            for a, b in zip(marks[:-1].tolist(), marks[1:].tolist()):
                n = max(1, -(-(b - a - (CHUNK - STEP)) // STEP))
                picked = np.unique(np.linspace(0, n - 1, min(n, SAMPLE_CHUNKS)).astype(int))
                cuts.append([data[a + i * STEP:min(a + i * STEP + CHUNK, b)].tobytes() for i in picked.tolist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cuts, pa.list_(pa.binary()))], ["doc_id", "cuts"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = read.join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(frugal(chunks), "doc_id long, cuts array<binary>")
    rows = found.groupBy("doc_id").agg(F.min("cuts").alias("cuts")).collect()  # a repeated id counts once
    rows.sort(key=lambda r: r["doc_id"])
    return fit([[bytes(c) for c in r["cuts"]] for r in rows], np.array([chosen[r["doc_id"]] for r in rows], float))


def score(docs: DataFrame, network: Network, keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Columns `keep` (default doc_id), then score and predicted, for every whole text (null: empty)."""
    keep = [c for c in (keep if keep is not None else ["doc_id"]) if c not in ("score", "predicted")]
    sent = shared(docs.sparkSession, network)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1_000_000):
            data, marks = joined_bytes(part.column("text"))
            out = _in_steps(sent(), data, marks)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + [pa.array(out), pa.array((out >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "score double, predicted int"])
    return docs.select(*{*keep, "text"}).mapInArrow(frugal(scored), schema)


def _in_steps(network: Network, data: np.ndarray, marks: np.ndarray) -> np.ndarray:
    symbols, doc = chunked(data, marks)
    return network.scores(symbols, doc, len(marks) - 1)


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by a network trained outside the held-out fold.

    Repeated rows get the same score. A null doc_id is in no fold (held_out is null). Without labels of both kinds every score
    is the share of label 1 among them, smoothed.
    """
    out = score(docs, train(docs, labels))
    return out.select("doc_id", (remainder("doc_id") == 2).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with all their columns."""
    named = {c: f"_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    renamed = docs.select(*(F.col(f"`{c}`").alias(named.get(c, c)) for c in docs.columns))
    kept = score(renamed, train(docs, labels), keep=[named.get(c, c) for c in docs.columns]).where("predicted = 1")
    return kept.select(*(F.col(named.get(c, c)).alias(c) for c in docs.columns))
