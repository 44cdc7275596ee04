"""Token-ID files: ids in the fewest bits that hold the vocabulary, with offsets for random access.

Layout of a file, little-endian:

    magic 8 bytes | bits u32 | ids per block u32                                    (head)
    blocks: every full block holds the same number of ids, packed bit by bit, each starting on a byte
    doc ids i64[n] | 1 for a null doc id u8[n] | first id of each doc u64[n + 1]    (index)
    block offsets u64[b + 1]
    index offset u64 | docs u64 | ids u64 | blocks u64 | magic 8 bytes              (tail)

A reader takes the tail, the index, and then any block by its offset.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import documents, record_batch
from waferline.llm.tokens import encoded, encoder
from waferline.session import cut_lineage, run_dir

MAGIC = b"WLTOKEN1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 26


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return planes.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class TokenWriter:
    """Writes one file, a block at a time; only the index grows in memory."""

    def __init__(self, uri: str, bits: int, block: int = BLOCK_IDS):
        system, path = fs.FileSystem.from_uri(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.bits, self.block = system.open_output_stream(path), bits, block
        self.docs: list[int | None] = []
        self.starts, self.offsets, self.pending, self.waiting, self.ids = [0], [], [], 0, 0
        self.out.write(MAGIC + np.array([bits, block], "<u4").tobytes())

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.ids += len(ids)
        self.starts.append(self.ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            rest = np.concatenate(self.pending)
            whole = len(rest) // self.block * self.block
            for low in range(0, whole, self.block):
                self._write(rest[low : low + self.block])
            self.pending, self.waiting = [rest[whole:].copy()], len(rest) - whole

    def _write(self, ids: np.ndarray) -> None:
        self.offsets.append(self.out.tell())
        self.out.write(pack(ids, self.bits))

    def close(self) -> None:
        if self.waiting:
            self._write(np.concatenate(self.pending))
        at = self.out.tell()
        ids = np.array([d or 0 for d in self.docs], "<i8")
        nulls = np.array([d is None for d in self.docs], "u1")
        self.out.write(ids.tobytes() + nulls.tobytes() + np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([*self.offsets, at], "<u8").tobytes())
        self.out.write(np.array([at, len(self.docs), self.ids, len(self.offsets)], "<u8").tobytes() + MAGIC)
        self.out.close()


class TokenReader:
    """Random access to the documents and ids of one file."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        head, tail = self.file.read_at(16, 0), self.file.read_at(40, size - 40)
        if head[:8] != MAGIC or tail[32:] != MAGIC:
            raise ValueError(f"{uri} is not a whole token file")
        self.bits, self.block = (int(x) for x in np.frombuffer(head, "<u4", 2, 8))
        at, docs, self.ids, blocks = (int(x) for x in np.frombuffer(tail, "<u8", 4))
        index = self.file.read_at(size - 40 - at, at)
        self.docs = np.frombuffer(index, "<i8", docs)
        self.nulls = np.frombuffer(index, "u1", docs, 8 * docs)
        self.starts = np.frombuffer(index, "<u8", docs + 1, 9 * docs).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", blocks + 1, 17 * docs + 8).astype(np.int64)
        self.kept, self.kept_ids = -1, np.empty(0, np.uint32)

    def _block(self, b: int) -> np.ndarray:
        if b != self.kept:
            n = min(self.block, self.ids - b * self.block)
            size = int(self.offsets[b + 1] - self.offsets[b])
            self.kept, self.kept_ids = b, unpack(self.file.read_at(size, int(self.offsets[b])), self.bits, n)
        return self.kept_ids

    def slice(self, low: int, high: int) -> np.ndarray:
        """Ids ``low`` up to ``high`` of the file."""
        parts = []
        for b in range(low // self.block, -(-high // self.block)):
            base = b * self.block
            parts.append(self._block(b)[max(low - base, 0) : high - base])
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def doc(self, i: int) -> np.ndarray:
        return self.slice(int(self.starts[i]), int(self.starts[i + 1]))

    def doc_id(self, i: int) -> int | None:
        return None if self.nulls[i] else int(self.docs[i])

    def close(self) -> None:
        self.file.close()


_MANIFEST = "path string, part int, number int, n_docs bigint, n_ids bigint, bits int"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_files(docs: DataFrame, vocabulary: str, folder: str | None = None, file_ids: int = FILE_IDS, block: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the list of files with their ``start``.

    Rows are dealt out by ranges of doc_id, and each task writes its range, a new file after ``file_ids``
    ids. ``folder`` must be reachable by all executors; by default it lies in the cluster's shared folder.
    A file's name is new for each attempt, and the list, which is written to the shared folder, names only
    the files of attempts that ended well. Null text is empty; null ids come first; rows with the same id
    follow each other by text. An empty table gives no file.
    """
    spark = docs.sparkSession
    target = folder or run_dir(spark)
    target = target if "://" in target else "file://" + target.removeprefix("file:")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, made, writer, path = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None, ""
        bits = bits_for(encoder(vocabulary).vocabulary)

        def close() -> None:
            writer.close()
            made.append((path, part, len(made), len(writer.docs), writer.ids, bits))

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, _, flat, cuts in encoded(batch.column(1), vocabulary):
                for i in range(len(cuts) - 1):
                    if writer is None:
                        path = f"{target}/tokens-{part:06d}-{len(made):04d}-{own}.bin"
                        writer = TokenWriter(path, bits, block)
                    writer.add(ids[low + i], flat[cuts[i] : cuts[i + 1]])
                    if writer.ids >= file_ids:
                        close()
                        writer = None
        if writer is not None:
            close()
        if made:
            yield pa.RecordBatch.from_pydict({"path": [m[0] for m in made], "part": pa.array([m[1] for m in made], pa.int32()), "number": pa.array([m[2] for m in made], pa.int32()), "n_docs": [m[3] for m in made], "n_ids": [m[4] for m in made], "bits": pa.array([m[5] for m in made], pa.int32())})

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents(docs).repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text")
    files = cut_lineage(rows.mapInArrow(write, _MANIFEST))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_files(files: DataFrame) -> DataFrame:
    """One row per document of the listed files: doc_id, start over all files, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenReader(path)
                for low in range(0, len(file.docs), 10_000):
                    span = range(low, min(low + 10_000, len(file.docs)))
                    crcs = [zlib.crc32(file.doc(i).astype("<u4")) for i in span]
                    cuts = file.starts[low : span.stop + 1]
                    yield record_batch(_DOCS, [[file.doc_id(i) for i in span], start + cuts[:-1], np.diff(cuts), crcs])
                file.close()

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = files.select("path", "start").repartition(tasks, "path")
    return listed.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
