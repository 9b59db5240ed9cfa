"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import pickle
import string
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import remove, work_folder
from . import words as W

SLICE = 1_500_000  # bytes of text that one step of numpy work looks at


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a frame into the shared work folder and read it back: nothing before it runs again, and no executor's loss undoes it."""
    return _written(df, compression)[0]


def _written(df: DataFrame, compression: str) -> tuple[DataFrame, str]:
    path = work_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


_STORED = "_stored_at"


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """As `staged`, for a table that `discarded` deletes once nothing reads it any more."""
    out, path = _written(df, compression)
    setattr(out, _STORED, path)
    return out


def discarded(*tables: DataFrame) -> None:
    """Delete tables made by `stored`, and let Spark delete the shuffles of finished steps: it does when their frames are collected as garbage."""
    for t in tables:
        remove(t.sparkSession, getattr(t, _STORED))
    gc.collect()
    tables[0].sparkSession.sparkContext._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def plan_bytes(df: DataFrame) -> int:
    """What Spark expects the frame to hold, from its statistics; no data is read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """Shuffle partitions for a frame: the session's number, or more where the data asks for it."""
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(asked, min(-(-plan_bytes(df) // bytes_each), 200_000))


def shared(spark: SparkSession, value):
    """A function that gives `value` inside tasks, from a broadcast that carries its classes: executors need no copy of this package."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    made: list = []

    def received():
        if not made:
            made.append(pickle.loads(sent.value))
        return made[0]

    return received


def worker_memory(name: str, make):
    """A value kept by a Python worker between tasks (the worker is reused; losing it only costs time)."""
    kept = sys.modules.setdefault("_grantlens_worker", types.ModuleType("_grantlens_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def released() -> None:
    """Hand back to the machine what a finished step of a worker no longer needs: idle workers stand beside the executor's own memory."""
    W.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(steps):
    """A function over the batches of a task that hands its memory back when the task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from steps(batches)
        finally:
            released()

    return run


def frugal_groups(step, each: int = 16):
    """A function over the tables of a group that hands its memory back after every `each` groups of a worker."""
    done = [0]

    def counted(out: pa.Table) -> pa.Table:
        done[0] += 1
        if done[0] % each == 0:
            released()
        return out

    # Spark reads the number of tables from the signature.
    if step.__code__.co_argcount == 2:
        return lambda left, right: counted(step(left, right))
    return lambda table: counted(step(table))


def packed(columns: dict[str, pa.Array]) -> bytes:
    """A record batch as one compressed value."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(values: pa.Array) -> list[pa.Table]:
    return [pa.ipc.open_stream(v.as_buffer()).read_all() for v in values]


def in_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """block, texts: neighbouring rows in one compressed value for about `limit` bytes of their column text.

    Stored, so that all passes see the same blocks and only compressed text is shuffled. A longer text is a block of its own.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, n = TaskContext.get().partitionId() << 32, 0
        for part in _of_size(batches, limit):
            yield pa.RecordBatch.from_arrays([pa.array([first + n]), pa.array([packed(part)], pa.binary())], ["block", "texts"])
            n += 1

    return staged(rows.mapInArrow(frugal(pack), "block long, texts binary"))


def _of_size(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[dict[str, pa.Array]]:
    """Rows of a partition in turn, until their texts hold `limit` bytes."""
    have, size = [], 0
    for part in slices(batches, "text", limit // 4):
        n = int(text_lengths(part.column("text")).sum())
        if have and size + n > limit:
            yield _merged(have)
            have, size = [], 0
        have.append(part)
        size += n
    if have:
        yield _merged(have)


def _merged(parts: list[pa.RecordBatch]) -> dict[str, pa.Array]:
    return {c: pa.concat_arrays([p.column(c) for p in parts]) for c in parts[0].schema.names}


def per_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    for batch in batches:
        for i, block in enumerate(batch.column("block").to_pylist()):
            yield block, unpacked(batch.column("texts").slice(i, 1))[0]


def column(table: pa.Table, name: str) -> pa.Array:
    """A table's column as one array."""
    found = table[name]
    return found.chunk(0) if found.num_chunks == 1 else pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)


def text_lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text (null: 0)."""
    _, ends = text_bounds(texts)
    return ends - _


def text_bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of each text in the array's data buffer (null: an empty range)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    marks = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1 + texts.offset)[texts.offset:].astype(np.int64)
    first, end = marks[:-1].copy(), marks[1:].copy()
    if texts.null_count:
        gone = texts.is_null().to_numpy(zero_copy_only=False)
        end[gone] = first[gone]
    return first, end


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut batches at rows so that the texts of a piece hold about `limit` bytes; a longer text is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = np.cumsum(text_lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the n + 1 marks between them."""
    first, end = text_bounds(texts)
    size = end - first
    marks = np.concatenate(([0], np.cumsum(size)))
    if not marks[-1]:
        return np.zeros(0, np.uint8), marks
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    if texts.null_count or (first[1:] != end[:-1]).any():
        return np.concatenate([data[a:b] for a, b in zip(first, end)]), marks
    return data[first[0]:end[-1]], marks


def lists(values: np.ndarray, marks: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(marks.astype(np.int32)), pa.array(values, kind))


def binaries(data: np.ndarray, marks: np.ndarray) -> pa.Array:
    """A binary column whose i-th value holds data[marks[i]:marks[i + 1]] as bytes."""
    raw = np.ascontiguousarray(data)
    ends = (np.asarray(marks, np.int64) * raw.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
