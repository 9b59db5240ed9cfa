"""Best-fit packing of token pieces into sequences of a fixed capacity.

The plan is made on the histogram of lengths, which has at most `capacity` entries however many documents there are:

1. Linear grouping: large lengths, longest first, are cut into groups of equal cardinality, and each is rounded up to the
   longest length of its group.
2. The few rounded sizes are packed by the configuration linear program (column generation with a knapsack); each
   configuration is used as often as the solution's whole part says.
3. Actual lengths take the places of their group's rounded size, longest first, so gaps are exact.
4. What is left, and all small lengths, go longest first to the tightest gap that holds them, many equal ones at a time.

The plan says for each length which ranks go to which sequences and offsets. Documents are ranked within their length
in shards, so a length that a third of all documents share is spread over many tasks, and each looks up its place.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, slices, staged
from .tokens import encoder

CAPACITY = 4096
GROUPS = (32, 64)  # numbers of groups to try; the plan with fewer sequences is kept
SHARD_ROWS = 200_000  # rows that one shard ranks, on average
SHARDS = 64  # and shards at least
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Encode every whole text and cut its ids into pieces of at most `capacity`: doc_id, piece, start, length, ids_crc32.

    A null text is the end id alone. Columns other than doc_id and text are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for part in slices(batches, "text", 4_000_000):
            ids, marks = coder.of_texts(part.column("text"), end_id)
            raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
            n = -(-np.diff(marks) // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = marks[doc] + piece * capacity
            size = np.minimum(marks[doc + 1] - first, capacity)
            sums = [zlib.crc32(raw[4 * a:4 * (a + b)]) for a, b in zip(first.tolist(), size.tolist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(piece * capacity, pa.int64()), "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(frugal(cut), PIECES)


@dataclass
class Plan:
    """Places: ranks [rank, rank + bins * copies) of a length go, `copies` each, to `bins` sequences from `first` on."""

    capacity: int
    sequences: int = 0
    used: dict[int, int] = field(default_factory=dict)
    places: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, rank, first, copies, offset
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # gap: (first sequence, how many)
    order: list[int] = field(default_factory=list)  # the gaps there are, ascending

    def open(self, bins: int) -> int:
        self.sequences += bins
        return self.sequences - bins

    def put(self, length: int, first: int, bins: int, copies: int, gap: int) -> int:
        """Place bins * copies documents of a length into sequences with the same gap; what gap remains."""
        rank = self.used.get(length, 0)
        self.used[length] = rank + bins * copies
        self.places.append((length, rank, first, copies, self.capacity - gap))
        return gap - copies * length

    def keep(self, gap: int, first: int, bins: int) -> None:
        if bins and gap:
            if gap not in self.gaps:
                self.gaps[gap] = []
                bisect.insort(self.order, gap)
            self.gaps[gap].append((first, bins))

    def best_fit(self, length: int, n: int) -> None:
        """Place n documents of a length into the tightest gaps, and into new sequences when none is left."""
        while n:
            at = bisect.bisect_left(self.order, length)
            if at == len(self.order):
                gap, first, bins = self.capacity, None, -(-n // (self.capacity // length))
                first = self.open(bins)
            else:
                gap = self.order[at]
                first, bins = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap], self.order[at]
            most = gap // length
            full = min(bins, n // most)
            if full:
                self.keep(self.put(length, first, full, most, gap), first, full)
                n -= full * most
            if n and full < bins:
                self.keep(self.put(length, first + full, 1, n, gap), first + full, 1)
                n, full = 0, full + 1
            self.keep(gap, first + full, bins - full)


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, longest first, in groups of equal cardinality: lists of (length, count)."""
    each = max(1, -(-sum(counts.values()) // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not room:
                out.append([])
                room = each
            take = min(n, room)
            out[-1].append((length, take))
            n, room = n - take, room - take
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """The configuration linear program by column generation: (copies of each size, how often), not rounded."""
    k = len(sizes)
    columns = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(60 * k):
        amount = np.linalg.solve(columns, need)
        price = np.linalg.solve(columns.T, np.ones(k))
        best, value = _knapsack(sizes, price, capacity)
        if value <= 1 + 1e-9:
            break
        direction = np.linalg.solve(columns, best)
        ratio = np.where(direction > 1e-9, np.maximum(amount, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        columns[:, int(np.argmin(ratio))] = best
    return [(columns[:, i].round().astype(int), float(max(amount[i], 0))) for i in range(k)]


def _knapsack(sizes: list[int], price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The most valuable configuration: sizes one by one, up to as many copies as fit."""
    value = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int32)
    for i, s in enumerate(sizes):
        if price[i] <= 0:
            continue
        before = value.copy()
        for copies in range(1, capacity // s + 1):
            more = before[:capacity + 1 - copies * s] + copies * price[i]
            better = more > value[copies * s:] + 1e-12
            value[copies * s:][better] = more[better]
            taken[i, copies * s:][better] = copies
    best, room = np.zeros(len(sizes)), int(np.argmax(value))
    top = value[room]
    for i in range(len(sizes) - 1, -1, -1):
        best[i] = taken[i, room]
        room -= int(best[i]) * sizes[i]
    return best, float(top)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> Plan:
    """Where documents of each length go, from how many there are of each."""
    return min((_plan(counts, capacity, g) for g in groups), key=lambda p: p.sequences)


def _plan(counts: dict[int, int], capacity: int, groups: int) -> Plan:
    out = Plan(capacity)
    left = {length: n for length, n in counts.items() if length <= capacity // 8}
    pools = grouped({length: n for length, n in counts.items() if length > capacity // 8}, groups)
    sizes = [pool[0][0] for pool in pools]
    merged = sorted(set(sizes), reverse=True)  # groups that round up to the same size are one
    by_size: dict[int, list[tuple[int, int]]] = {s: [] for s in merged}
    for pool in pools:
        by_size[pool[0][0]] += pool
    demand = [sum(n for _, n in by_size[s]) for s in merged]
    for copies, often in configurations(merged, demand, capacity) if merged else []:
        bins = int(often + 1e-6)
        slots = [i for i, c in enumerate(copies) for _ in range(c)]
        bins = min([bins, *(demand[i] // copies[i] for i in set(slots))])
        if not bins or not slots:
            continue
        for i in set(slots):
            demand[i] -= int(copies[i]) * bins
        _substitute(out, bins, [by_size[merged[i]] for i in slots])
    for pool in by_size.values():
        for length, n in pool:
            left[length] = left.get(length, 0) + n
    for length in sorted(left, reverse=True):
        out.best_fit(length, left[length])
    return out


def _substitute(out: Plan, bins: int, slots: list[list[tuple[int, int]]]) -> None:
    """Fill new sequences: each slot takes its pool's longest documents, in runs of equal lengths."""
    runs = [(out.open(bins), bins, out.capacity)]
    for pool in slots:
        following = []
        for first, n, gap in runs:
            while n:
                length, have = pool[0]
                take = min(n, have)
                following.append((first, take, out.put(length, first, take, 1, gap)))
                if take == have:
                    pool.pop(0)
                else:
                    pool[0] = (length, have - take)
                first, n = first + take, n - take
        runs = following
    for first, n, gap in runs:
        out.keep(gap, first, n)


def ranked(rows: DataFrame, shards: int) -> DataFrame:
    """Number the rows of each length from 0: inside shards first, then by what earlier shards hold."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    inside = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = dealt.withColumn("rank", F.row_number().over(inside) - 1)
    return numbered.join(before, ["length", "shard"]).withColumn("rank", F.col("rank") + F.col("before")).drop("shard", "before")


def place(rows: DataFrame, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """Add sequence_id and offset to pieces (columns of `pieces`); rows is read twice, so give a stored table.

    Equal rows are interchangeable. Lengths must be 1 to `capacity`. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = plan(counts, capacity, groups)
    table = np.array(sorted(made.places), np.int64).reshape(-1, 5)
    # Its size depends on the lengths there can be, not on how many documents have them.
    shared = spark.sparkContext.broadcast(table)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        begin = np.searchsorted(places[:, 0], np.arange(capacity + 2))
        # One ascending key for (length, rank).
        widest = int(places[:, 1].max(initial=0)) + 1
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            if widest < 1 << 48:
                key = np.searchsorted((places[:, 0] << 48) + places[:, 1], (length << 48) + rank, "right") - 1
            else:
                key = np.array([begin[a] + np.searchsorted(places[begin[a]:begin[a + 1], 1], r, "right") - 1 for a, r in zip(length, rank)])
            _, start, first, copies, offset = places[key].T
            which = (rank - start) // copies
            columns = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            columns |= {"sequence_id": pa.array(first + which), "offset": pa.array(offset + (rank - start - which * copies) * length)}
            yield pa.RecordBatch.from_pydict(columns)

    shards = max(SHARDS, -(-sum(counts.values()) // SHARD_ROWS))
    return ranked(rows, shards).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")).mapInArrow(
        look_up, PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(staged(pieces(docs, tokenizer, capacity, end_id)), capacity)
