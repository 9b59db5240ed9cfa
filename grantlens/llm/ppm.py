"""Text scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER bytes with the counts of what follows each, over all training texts. A byte
is coded in the longest context that training has seen; a context that never saw it costs an escape (method D: each different symbol gives half an
occurrence to it), after which shorter contexts leave out the symbols already ruled out. Texts end with an end symbol.

What a symbol costs depends on it and the ORDER symbols before it alone, so each different run of ORDER + 1 symbols of a block of texts is asked for
once and answered by one number. Runs are dealt to buckets by the last two symbols of their context: a bucket holds all contexts with that ending,
from order two to the longest, and builds its part of the trie with the sums that exclusion needs; the two shortest orders
(at most 257 * 257 counts, whatever the corpus) are broadcast. Blocks are merged in crowds of bounded size, first into the trie and then, beside
the finished trie, for their answers, so no task holds what a suffix has in all blocks. Answers are 32-bit numbers, which hold a run's cost to seven
digits; they are added up in double precision. Word counts of the unigram base travel the same way, by
hash of the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import column, discarded, frugal, frugal_groups, in_blocks, joined_bytes, packed, per_block, shared, stored, unpacked

ORDER = 5
BLOCK = 3_500_000  # bytes of text
END, START, BITS = 256, 257, 9  # symbols after the 256 bytes; bits of a symbol in a code
ALPHABET = 257  # what can follow a context
SUFFIX = 2  # symbols of a context's end that choose its bucket
CROWD = 64  # blocks merged at a time
BLOCKS_EACH = 35  # blocks for each bucket, when many
LEAST_BUCKETS, MOST_BUCKETS = 8, 4096
MERGE = 2_000_000  # entries gathered before they are merged
TOLD = 1 << 20  # entries in a value
END_WORD = b" end"  # no word holds a space
SYMBOL = (1 << BITS) - 1


def _blocks(docs: DataFrame) -> DataFrame:
    """block, texts with doc_id, held_out and text."""
    return in_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1).alias("held_out"), F.col("text").alias("text")), BLOCK)


class Contexts:
    """The runs of order + 1 symbols of a block's texts, numbered densely order by order.

    A run's code holds its context, the last symbol lowest, above the symbol that follows it.
    """

    def __init__(self, texts: pa.Array, order: int = ORDER):
        data, marks = joined_bytes(texts)
        n = len(marks) - 1
        self.marks = marks + np.arange(n + 1)  # an end symbol follows each text
        self.symbols = np.full(self.marks[-1], END, np.uint16)
        inside = np.ones(len(self.symbols), bool)
        inside[self.marks[1:] - 1] = False
        self.symbols[inside] = W.LOWER[data]
        used = np.zeros(START + 1, bool)
        used[self.symbols] = used[START] = True
        dense, self.used = np.cumsum(used) - 1, np.flatnonzero(used)
        self.width = len(self.used)
        stream = dense.astype(np.uint16)[self.symbols]
        keys = np.zeros(1, np.int64)
        at = np.zeros(len(stream), np.int32)
        for k in range(1, order + 1):
            before = np.full(len(stream), dense[START], np.uint16)
            before[k:] = stream[:-k]
            begin = (self.marks[:-1, None] + np.arange(k)).ravel()  # places with fewer than k symbols before them
            before[begin[begin < np.repeat(self.marks[1:], k)]] = dense[START]
            at, codes = _numbered(at, before, len(keys), self.width)
            keys = keys[codes // self.width] | self.used[codes % self.width] << (BITS * (k - 1))
        self.runs, codes = _numbered(at, stream, len(keys), self.width)  # the number of the run that ends with each symbol
        self.codes = keys[codes // self.width] << BITS | self.used[codes % self.width]


def _numbered(high: np.ndarray, low: np.ndarray, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0.. for the distinct codes high * width + low (high below `rows`), in their order, and those codes."""
    limit = rows * width
    if limit > 100_000_000:
        found, which = np.unique(high.astype(np.int64) * width + low, return_inverse=True)
        return which.astype(np.int32), found
    codes = high * np.int32(width)
    np.add(codes, low, out=codes, casting="unsafe")
    seen = np.zeros(limit, bool)
    seen[codes] = True
    found = np.flatnonzero(seen)
    number = np.zeros(limit, np.int32)
    number[found] = np.arange(len(found), dtype=np.int32)
    return number[codes], found


def _trains(texts: pa.Table) -> pa.Array:
    return pc.fill_null(pc.invert(column(texts, "held_out")), False)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers of all texts one after another, marks between texts, and the distinct words as bytes."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    marks = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))))
    marks = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))[marks]
    deal = flat.filter(full).dictionary_encode()
    return deal.indices.to_numpy(), marks, deal.dictionary.cast(pa.binary())


def _buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mixed(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _dealt(bucket: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with its members, in the given order."""
    order = order[np.argsort(bucket[order], kind="stable")]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)])).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield int(bucket[order[a]]), order[a:b]


def _ending(codes: np.ndarray, order: int) -> np.ndarray:
    return codes >> BITS & ((1 << BITS * min(order, SUFFIX)) - 1)


def _runs_by_bucket(c: Contexts, order: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    return _dealt(_buckets_of(_ending(c.codes, order), buckets), np.argsort(c.codes, kind="stable"))


def _runs(codes: np.ndarray, n: np.ndarray) -> bytes:
    return packed({"code": pa.array(np.diff(codes, prepend=np.int64(0))), "n": pa.array(n.astype(np.uint32 if n.max(initial=0) < 1 << 32 else np.int64))})


def _read_runs(told: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.cumsum(column(t, "code").to_numpy()), column(t, "n").to_numpy().astype(np.int64)) for t in unpacked(told)]


LOTS = "kind string, bucket long, block long, size long, told binary"


def lots(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """The different runs and words of each block and how often its training texts hold them, one compressed row for each bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in per_block(batches):
            texts, trains = column(part, "text"), _trains(part).to_numpy(zero_copy_only=False)
            out = []
            c = Contexts(texts, order)
            n = np.bincount(c.runs[np.repeat(trains, np.diff(c.marks))], minlength=len(c.codes))
            for bucket, at in _runs_by_bucket(c, order, buckets):
                out.append(("run", bucket, block, len(at), _runs(c.codes[at], n[at])))
            del c
            which, marks, found = words_of(texts)
            n = np.append(np.bincount(which[np.repeat(trains, np.diff(marks))], minlength=len(found)), trains.sum())
            found = pa.concat_arrays([found, pa.array([END_WORD], pa.binary())])
            for bucket, at in _dealt(_buckets_of(_prints(found), buckets), np.arange(len(found))):
                out.append(("word", bucket, block, len(at), packed({"word": found.take(pa.array(at)), "n": pa.array(n[at])})))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                             ["kind", "bucket", "block", "size", "told"])

    return blocks.mapInArrow(frugal(deal), LOTS)


def _prints(found: pa.Array) -> np.ndarray:
    data, marks = joined_bytes(found)
    return W.fingerprints(data, marks[:-1], marks[1:])


def _merged_runs(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with their sums; never more than MERGE entries wait beside them."""
    total, waiting, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
    for codes, n in parts:
        waiting.append((codes[n > 0], n[n > 0]))
        size += len(waiting[-1][0])
        if size > MERGE:
            total, waiting, size = _sums([total, *waiting]), [], 0
    return _sums([total, *waiting])


def _sums(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.diff(codes, prepend=np.int64(-1)))
    return codes[first], np.add.reduceat(n, first) if len(first) else n


SUMS = "bucket long, size long, told binary"


def _sum_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket: list[int] = []

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            bucket[:] = batch.column("bucket")[:1].to_pylist() or bucket
            for i in range(batch.num_rows):
                yield from _read_runs(batch.column("told").slice(i, 1))

    codes, n = _merged_runs(parts())
    for at in range(0, len(codes), TOLD):
        part = codes[at:at + TOLD]
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array([len(part)]), pa.array([_runs(part, n[at:at + TOLD])], pa.binary())], ["bucket", "size", "told"])


def _sum_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket, total, waiting, size = [], None, [], 0
    for batch in batches:
        bucket = batch.column("bucket")[:1].to_pylist() or bucket
        for t in unpacked(batch.column("told")):
            waiting.append(t.filter(pc.greater(t["n"], 0)))
            size += len(waiting[-1])
            if size > MERGE:
                total, waiting, size = _word_sums(total, waiting), [], 0
    total = _word_sums(total, waiting)
    for at in range(0, len(total), TOLD):
        part = total.slice(at, TOLD)
        told = packed({"word": column(part, "word"), "n": column(part, "n")})
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array([len(part)]), pa.array([told], pa.binary())], ["bucket", "size", "told"])


def _word_sums(total: pa.Table | None, waiting: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables([t for t in (total, *waiting) if t is not None])
    return both.group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks()


def whole_counts(dealt: DataFrame, kind: str, crowds: int) -> DataFrame:
    """bucket, size, told: the training counts of all blocks together (stored); crowds of blocks are merged first."""
    merge = {"run": _sum_runs, "word": _sum_words}[kind]
    rows = dealt.where(F.col("kind") == kind)
    if crowds > 1:
        rows = rows.withColumn("crowd", F.pmod(F.xxhash64("block"), F.lit(crowds))).groupBy("bucket", "crowd").applyInArrow(merge, SUMS)
    return stored(rows.groupBy("bucket").applyInArrow(merge, SUMS), "uncompressed")


class Level:
    """The contexts of one order in a bucket: followers and their counts, totals, kinds, and what the followers amount to one order below."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts.astype(float)
        context = codes >> BITS
        first = np.flatnonzero(np.diff(context, prepend=np.int64(-1)))
        self.contexts = context[first]
        self.kinds = np.diff(first, append=len(codes)).astype(float)
        self.total = np.add.reduceat(self.counts, first) if len(first) else np.zeros(0)
        self.first, self.below = first, np.zeros(len(first))

    def exclude(self, shorter: Level, order: int) -> None:
        if len(self.first):
            self.below = np.add.reduceat(shorter.count(_shorter(self.codes, order - 1)), self.first)

    def count(self, codes: np.ndarray) -> np.ndarray:
        return _looked_up(self.codes, codes, self.counts)

    def place(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.contexts, contexts), max(len(self.contexts) - 1, 0))
        return at, (self.contexts[at] == contexts if len(self.contexts) else np.zeros(len(contexts), bool))


def _looked_up(known: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, values[at], 0.0)


def _shorter(codes: np.ndarray, order: int) -> np.ndarray:
    """Codes of the runs with only `order` symbols of context."""
    return (codes >> BITS & ((1 << BITS * order) - 1)) << BITS | codes & SYMBOL


class Trie:
    """All orders of a bucket, from its longest runs; `upper` has the codes and counts of the orders below SUFFIX."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, upper: list[tuple[np.ndarray, np.ndarray]], order: int):
        self.levels: list[Level] = [Level(codes, counts)]
        for k in range(order - 1, len(upper) - 1, -1):
            codes, counts = _sums([(_shorter(codes, k), counts)])
            self.levels.insert(0, Level(codes, counts))
        self.levels[:0] = [Level(*u) for u in upper[:order]]
        for k in range(1, order + 1):
            self.levels[k].exclude(self.levels[k - 1], k)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """The log10 probability of the last symbol of each run."""
        out = np.zeros(len(codes))
        waits, kinds, below = np.ones(len(codes), bool), np.zeros(len(codes)), np.zeros(len(codes))
        for k in range(len(self.levels) - 1, -1, -1):
            level, asked = self.levels[k], _shorter(codes, k)
            at, known = level.place(asked >> BITS)
            live = np.flatnonzero(waits & known)
            at = at[live]
            n, q, c = level.total[at] - below[live], level.kinds[at] - kinds[live], level.count(asked[live])
            hit = c > 0
            out[live[hit]] += np.log10((c[hit] - 0.5) / n[hit])
            waits[live[hit]] = False
            costs = ~hit & (q > 0)
            out[live[costs]] += np.log10(q[costs] / (2 * n[costs]))
            kinds[live[~hit]], below[live[~hit]] = level.kinds[at[~hit]], level.below[at[~hit]]
        out[waits] -= np.log10(ALPHABET - kinds[waits])
        return out


def shortest_orders(tries: DataFrame, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Codes and counts of the orders below SUFFIX: at most ALPHABET + ALPHABET * (ALPHABET + 1) rows reach the driver."""
    orders = list(range(min(order, SUFFIX)))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, n in _read_runs(batch.column("told")):
                for k in orders:
                    short, total = _sums([(_shorter(codes, k), n)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(short), k)), pa.array(short), pa.array(total)], ["k", "code", "n"])

    rows = tries.select("told").mapInArrow(sums, "k long, code long, n long").groupBy("k", "code").agg(F.sum("n").alias("n")).orderBy("k", "code").collect()
    return [tuple(np.array([r[x] for r in rows if r["k"] == k], np.int64) for x in ("code", "n")) for k in orders]


ANSWERS = "kind string, bucket long, block long, told binary"


def _answered(kind: str, asked: pa.Table, values: list[np.ndarray]) -> pa.Table:
    told = [packed({"value": pa.array(v)}) for v in values]
    return pa.table({"kind": pa.array([kind] * len(told)), "bucket": asked["bucket"], "block": asked["block"], "told": pa.array(told, pa.binary())})


def _beside(dealt: DataFrame, kind: str, whole: DataFrame, crowds: int, answer) -> DataFrame:
    """Answers to the lots of a kind, a crowd of blocks at a time beside what their bucket holds in all."""
    asked = dealt.where(F.col("kind") == kind).withColumn("crowd", F.pmod(F.xxhash64("block"), F.lit(crowds)))
    copies = whole.withColumn("crowd", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(crowds - 1).cast("long"))))
    return copies.groupBy("bucket", "crowd").cogroup(asked.groupBy("bucket", "crowd")).applyInArrow(frugal_groups(answer, 2), ANSWERS)


def answered_runs(dealt: DataFrame, tries: DataFrame, crowds: int, order: int) -> DataFrame:
    """The cost of every run that a block asked for, in the order of its lot."""
    upper = shared(dealt.sparkSession, shortest_orders(tries, order))

    def answer(held: pa.Table, asked: pa.Table) -> pa.Table:
        told = _read_runs(column(held, "told"))
        codes, n = _sums([(np.zeros(0, np.int64), np.zeros(0, np.int64)), *told])
        trie = Trie(codes, n, upper(), order)
        return _answered("run", asked, [trie.log10(codes).astype(np.float32) for codes, _ in _read_runs(column(asked, "told"))])

    return _beside(dealt, "run", tries, crowds, answer)


def answered_words(dealt: DataFrame, totals: DataFrame, crowds: int) -> DataFrame:
    """The training count of every word of a block, in the order of its lot."""

    def answer(held: pa.Table, asked: pa.Table) -> pa.Table:
        empty = pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        known = pa.concat_tables([empty, *unpacked(column(held, "told"))]).combine_chunks()
        words = [column(t, "word") for t in unpacked(column(asked, "told"))]
        at = pc.index_in(pa.chunked_array(words, pa.binary()), value_set=column(known, "word"))
        n = pc.fill_null(pc.take(column(known, "n"), at), 0).to_numpy()
        return _answered("word", asked, np.split(n, np.cumsum([len(w) for w in words])[:-1]) if words else [])

    return _beside(dealt, "word", totals, crowds, answer)


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text (null: empty).

    Rows with a null doc_id are in no fold: they are scored, not learned from. Repeated rows are scored, and learned from, each by
    itself. Without training texts every symbol is equally likely, and the base has no tokens (train_tokens 0). A text longer than a block is a
    block of its own. An empty table has no rows. Other columns are not read.
    """
    blocks = _blocks(docs)
    many = blocks.count()
    buckets = min(max(LEAST_BUCKETS, -(-many // BLOCKS_EACH)), MOST_BUCKETS)
    dealt = stored(lots(blocks, order, buckets), "uncompressed")
    sizes = {r["kind"]: r["n"] for r in dealt.groupBy("kind").agg(F.sum("size").alias("n")).collect()}
    crowds = -(-max(many, 1) // CROWD)
    tries, totals = (whole_counts(dealt, kind, crowds) for kind in ("run", "word"))

    def beside(kind: str, whole: DataFrame) -> int:
        """Crowds of blocks that ask for about as many entries as the whole counts have, or for MERGE in each bucket."""
        held = whole.agg(F.sum("size").alias("n")).first()["n"] or 0
        return max(1, (sizes.get(kind) or 0) // max(held, MERGE * buckets))

    trained = totals.mapInArrow(_token_sums, "tokens long, types long").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    train_tokens, types = int(trained["n"] or 0), int(trained["v"] or 0)
    costs = stored(answered_runs(dealt, tries, beside("run", tries), order), "uncompressed")
    discarded(tries)
    counts = stored(answered_words(dealt, totals, beside("word", totals)), "uncompressed")
    discarded(dealt, totals)

    def score(texts: pa.Table, told: pa.Table) -> pa.Table:
        values = [dict(zip(column(t, "bucket").to_pylist(), (column(x, "value").to_numpy() for x in unpacked(column(t, "told")))))
                  for t in (told.filter(pc.equal(told["kind"], kind)) for kind in ("run", "word"))]
        return _scored(pa.concat_tables(unpacked(column(texts, "texts"))), *values, train_tokens, types, order, buckets)

    both = blocks.groupBy("block").cogroup(costs.unionByName(counts).groupBy("block"))
    return both.applyInArrow(frugal_groups(score, 2), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _token_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [column(t, "n").to_numpy() for t in unpacked(batch.column("told"))]
        yield pa.RecordBatch.from_pydict({"tokens": pa.array([int(x.sum()) for x in n], pa.int64()), "types": pa.array([len(x) for x in n], pa.int64())})


def _scored(texts: pa.Table, runs: dict[int, np.ndarray], words: dict[int, np.ndarray], train_tokens: int, types: int, order: int, buckets: int) -> pa.Table:
    text = column(texts, "text")
    which, marks, found = words_of(text)
    c = np.zeros(len(found) + 1)
    for bucket, at in _dealt(_buckets_of(_prints(pa.concat_arrays([found, pa.array([END_WORD], pa.binary())])), buckets), np.arange(len(c))):
        c[at] = words[bucket]
    cost = np.log10((c + 0.5) / (train_tokens + 0.5 * (types + 1)))
    known = np.concatenate(([0], np.cumsum(c[which] > 0)))
    base = np.array([cost[which[a:b]].sum() for a, b in zip(marks[:-1].tolist(), marks[1:].tolist())]) + cost[-1]
    contexts = Contexts(text, order)
    costs = np.zeros(len(contexts.codes))
    for bucket, at in _runs_by_bucket(contexts, order, buckets):
        costs[at] = runs[bucket]
    total = np.add.reduceat(costs[contexts.runs], contexts.marks[:-1]) if len(text) else np.zeros(0)
    n = np.diff(marks)
    return pa.table({
        "doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": pa.array(n + 1),
        "n_known": pa.array(known[marks[1:]] - known[marks[:-1]] + int(c[-1] > 0)),
        "train_tokens": pa.array(np.full(len(n), train_tokens)), "base_score": pa.array(base), "score": pa.array(total)})
