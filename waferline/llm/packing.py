"""Best-fit packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import documents, record_batch
from waferline.llm.tokens import encoded
from waferline.session import cut_lineage

CAPACITY = 4096
#: Pieces that one task packs.
SHARD_PIECES = 200_000
#: Sequences emptier than this share meet those of other tasks in a further round.
LOOSE_FILL = 0.98


class OpenBins:
    """A segment tree over remaining capacities; a leaf holds the open bins that have just so much left."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, bin_: int, left: int) -> None:
        self.bins[left].append(bin_)
        node = self.leaves + left
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room that still holds ``size``: (bin, room)."""
        count, node = self.count, self.leaves + size
        while not count[node]:
            while node & 1:  # a right child: go up until there is a right neighbour
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        left = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return self.bins[left].pop(), left


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the offset of each piece. Equal lengths keep their order."""
    open_bins, bins = OpenBins(capacity), 0
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        found = open_bins.tightest(size)
        if found is None:
            found, bins = (bins, capacity), bins + 1
        bin_of[i], offset[i] = found[0], capacity - found[1]
        if found[1] > size:
            open_bins.put(found[0], found[1] - size)
    return bin_of, offset


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The token ids of each document with its end id, cut into pieces of ``capacity``: their place, length and checksum."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for low, high, flat, cuts in encoded(batch.column(1), vocabulary):
                size = np.diff(cuts)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(high - low), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(size[row] - piece * capacity, capacity)
                at = cuts[row] + piece * capacity
                flat = flat.astype("<u4")
                crc = [zlib.crc32(flat[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
                yield record_batch(_PIECES, [ids.slice(low, high - low).take(pa.array(row)), piece, piece * capacity, length, crc])

    return documents(docs).mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Place pieces (column ``length``, 1 to ``capacity``) in sequences: adds ``sequence_id`` and ``offset``.

    Full pieces are sequences by themselves. The others are dealt to tasks by a hash of their row number,
    ``shard_pieces`` at most on average, and each task packs its own best-fit decreasing. Every task leaves
    a few loose sequences; those of all tasks are taken apart and packed again, until they fit one task or
    the rounds bring nothing. No piece is cut or left out; rows that repeat are pieces of their own.
    A sequence's id is the row number of its first piece. An empty table gives no rows.
    """
    names = pieces.columns
    rows = cut_lineage(pieces.select(F.struct(*names).alias("row"), F.col("length").cast("bigint").alias("size")).withColumn("uid", F.monotonically_increasing_id()))
    full = rows.where(F.col("size") == capacity)
    done = full.select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", ignore_index=True)
        bins, offset = best_fit(group["size"].to_numpy(), capacity)
        first = np.empty(bins.max() + 1, np.int64)
        first[bins[offset == 0]] = group["uid"].to_numpy()[offset == 0]
        fill = np.bincount(bins, weights=group["size"]).astype(np.int64)
        return pd.DataFrame({"uid": group["uid"], "size": group["size"], "sequence_id": first[bins], "offset": offset, "fill": fill[bins]})

    todo = rows.where(F.col("size") < capacity).select("uid", "size")
    left = todo.count()
    while left:
        shards = -(-left // shard_pieces)
        dealt = todo.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
        placed = cut_lineage(dealt.groupBy("shard").applyInPandas(place, "uid bigint, size bigint, sequence_id bigint, offset bigint, fill bigint"))
        loose = F.lit(shards > 1) & (F.col("fill") < int(capacity * LOOSE_FILL))
        done = done.unionByName(placed.where(~loose).select("uid", "sequence_id", "offset"))
        todo = placed.where(loose).select("uid", "size")
        again = todo.count() if shards > 1 else 0
        if again > 0.9 * left:  # hardly anything packs tightly: keep what there is
            done = done.unionByName(placed.where(loose).select("uid", "sequence_id", "offset"))
            break
        left = again
    found = rows.select("uid", "row").join(done, "uid")
    return found.select("row.*", "sequence_id", "offset")
