"""Token ids as Arrow files of fixed-size lists.

Documents are put in ascending doc_id order by a range shuffle of their texts. Each partition writes one shard: an Arrow
file whose batches hold equal-length sequences (`ids`, fixed-size list) and their masks (`mask`, false where the last
sequence is padded), and an index file with (doc_id, start, n_tokens) per document. Both are uncompressed, so a
memory map gives any sequence without copying. A shard is written under a name of its own and then moved to its final name,
so a repeated task replaces its shard as a whole. Files go through `pyarrow.fs`, to a folder that all executors share.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for, slices, staged, work_folder
from .tokens import encoder

LENGTH = 2048  # ids of a sequence
BATCH = 256  # sequences of a record batch
MANIFEST = "shard int, path string, n_tokens long, n_docs long"


def _place(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def _sequence_schema(kind: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class _Shard:
    """Collects ids and writes whole batches as they fill."""

    def __init__(self, target, kind: pa.DataType, length: int):
        self.schema = _sequence_schema(kind, length)
        self.writer = pa.ipc.new_file(target, self.schema)
        self.kind, self.length, self.waiting, self.n_waiting, self.n = kind, length, [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind.to_pandas_dtype()))
        self.n_waiting += len(ids)
        self.n += len(ids)
        if self.n_waiting >= BATCH * self.length:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind.to_pandas_dtype())
        step = BATCH * self.length
        whole = len(ids) if last else len(ids) // step * step
        for at in range(0, whole, step):
            part = ids[at:min(at + step, whole)]
            rows = -(-len(part) // self.length)
            mask = np.arange(rows * self.length) < len(part)
            full = np.zeros(rows * self.length, part.dtype)
            full[:len(part)] = part
            self.writer.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (full, mask)], schema=self.schema))
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._write(True)
        self.writer.close()


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = LENGTH,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, write the shards into `folder`, and return the manifest of shards.

    A null text has the end id only; documents that repeat a doc_id follow one another by text; a null doc_id
    comes first. Other columns are not read. An empty table gives no shard, or empty ones.
    """

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        coder = encoder(tokenizer)
        files, root = _place(folder)
        name, own = f"{root}/shard-{number:06d}", f"{root}/.{uuid.uuid4().hex}"
        doc_ids, sizes = [], []
        with files.open_output_stream(f"{own}.ids") as target:
            out = _Shard(target, pa.uint16() if coder.small else pa.uint32(), length)
            for part in slices(batches, "text", 4_000_000):
                ids, marks = coder.of_texts(part.column("text"), end_id)
                out.add(ids)
                doc_ids.append(part.column("doc_id"))
                sizes.append(np.diff(marks))
            out.close()
        if not doc_ids:
            files.delete_file(f"{own}.ids")
            return
        n = np.concatenate(sizes)
        index = pa.table({"doc_id": pa.chunked_array(doc_ids).combine_chunks(), "start": np.cumsum(n) - n, "n_tokens": n})
        with files.open_output_stream(f"{own}.docs") as target, pa.ipc.new_file(target, index.schema) as writer:
            writer.write_table(index, max_chunksize=65536)
        for kind in ("ids", "docs"):
            files.move(f"{own}.{kind}", f"{name}.{kind}.arrow")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int32()), "path": [name], "n_tokens": [out.n], "n_docs": [len(n)]})

    _place(folder)[0].create_dir(_place(folder)[1], recursive=True)
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = read.repartitionByRange(partitions_for(read, 256 << 20), "doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(shard, MANIFEST))


def sequence(ids_file: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence `number` of a shard and its mask, from a memory map of a local file: no other byte is read."""
    with pa.memory_map(ids_file) as source:
        file = pa.ipc.open_file(source)
        batch = file.get_batch(number // BATCH)
        at = number % BATCH
        return (batch.column("ids")[at].values.to_numpy(),
                batch.column("mask")[at].values.to_numpy(zero_copy_only=False))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _place(folder)
        for batch in batches:
            for path, offset in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist()):
                yield from _documents(files, path, offset)

    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("offset", F.coalesce(before, F.lit(0))).select("path", "offset")
    spread = placed.repartition(partitions_for(manifest, 1 << 30), "path")
    return spread.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(files, path: str, offset: int) -> Iterator[pa.RecordBatch]:
    with files.open_input_file(f"{path}.docs.arrow") as a, files.open_input_file(f"{path}.ids.arrow") as b:
        index, ids = pa.ipc.open_file(a), pa.ipc.open_file(b)
        have, first, next_batch = np.zeros(0, np.uint16), 0, 0
        for i in range(index.num_record_batches):
            docs = index.get_batch(i)
            start, size = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
            sums = np.zeros(len(start), np.int64)
            for k, (at, n) in enumerate(zip(start.tolist(), size.tolist())):
                crc = 0
                while n:
                    while at >= first + len(have):
                        first += len(have)
                        have = _unmasked(ids.get_batch(next_batch))
                        next_batch += 1
                    part = have[at - first:at - first + n]
                    crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    at, n = at + len(part), n - len(part)
                sums[k] = crc
            yield pa.RecordBatch.from_pydict({"doc_id": docs.column("doc_id"), "start": pa.array(start + offset),
                                              "n_tokens": docs.column("n_tokens"), "ids_crc32": pa.array(sums)})


def _unmasked(batch: pa.RecordBatch) -> np.ndarray:
    ids = batch.column("ids").flatten().to_numpy()
    return ids[batch.column("mask").flatten().to_numpy(zero_copy_only=False)]


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH) -> DataFrame:
    """Write all documents to token files in the shared work folder and return one row per document from them."""
    folder = work_folder(docs.sparkSession)
    return read(write(docs, folder, tokenizer, end_id, length), folder)

