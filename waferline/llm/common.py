"""Reading tables, folds of labelled rows, and batches of text as flat bytes."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into flat arrays at once.
BLOCK_BYTES = 1 << 20
#: The labelled sample comes to the driver in so many parts, one after the other.
SAMPLE_PARTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """The id and text columns, and ``more``, whatever else the table holds."""
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"), *[docs[c] for c in more])


def carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and ``rest``: all other columns as one, so that no name of theirs clashes with another."""
    rest = [docs[c] for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(None).cast("int").alias("_")).alias("rest"))


def uncarried(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from doc_id, text and ``rest``; ``changed`` gives some of them anew."""
    kept = [changed.get(c, F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c)) for c in docs.columns]
    return rows.select(*[c.cast(docs.schema[name].dataType).alias(name) for c, name in zip(kept, docs.columns)])


def fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """Up to ``limit`` labelled texts, half of each class, and the class sizes over all training rows.

    Rows come in the order of a hash of their id, so the sample is the same for the same table. The ids
    (at most ``limit`` of them) are broadcast; the texts come to the driver, which fits the model, part by
    part, so that Spark's side of the driver holds one part at a time.
    """
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels[label].cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(train)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {int(r["y"]): int(r["count"]) for r in known.groupBy("y").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.where(F.col("y") == y).orderBy(*order).limit(limit // 2) for y in (0, 1)]
    picked = parts[0].unionByName(parts[1])
    found = documents(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y")
    rows = sorted((r["doc_id"], r["text"] or "", int(r["y"])) for r in found.repartition(SAMPLE_PARTS).toLocalIterator())
    return [(text, y) for _, text, y in rows], sizes


def give_back() -> None:
    """Memory that this process has freed goes back to the system; Arrow and the C library would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    buffers = column.buffers()
    bounds = np.frombuffer(buffers[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if buffers[2] is None or not len(bounds):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def text_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of rows of about ``size`` bytes; a longer text is a run of its own."""
    data, bounds = flat_text(column)
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = int(np.searchsorted(bounds, bounds[low] + size, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def list_blocks(texts: list[str], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``text_blocks`` of a list: a few texts at a time are held a second time, as bytes."""
    for start in range(0, len(texts), 512):
        for low, high, data, bounds in text_blocks(pa.array(texts[start : start + 512], pa.string()), size):
            yield start + low, start + high, data, bounds


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
