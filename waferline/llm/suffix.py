"""Removal of repeated passages of bytes, by suffix arrays of shards that hold all that can repeat together.

Every window of ``length`` bytes is marked by its least hash of ``ANCHOR`` bytes. Equal windows have equal
marks, so runs of windows with one mark go to one shard. Of equal runs only the first is kept (the others
repeat it as a whole), and a run whose mark or surroundings occur once repeats nothing. What is left, the
rims of repeated passages, is sorted by suffixes shard by shard (``induced``): in order, windows that share
``length`` bytes stand side by side, and all but the first in the corpus are repeats.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructType

from waferline.llm.common import flat_text, record_batch, text_blocks
from waferline.llm.induced import suffix_array
from waferline.llm.words import mix, powers
from waferline.session import cut_lineage

LENGTH = 100
ANCHOR = 24
#: Longest run of windows in one row; longer ones are cut, which leaves every window in one row.
RUN = 400
#: Bytes of a shard that one task sorts, on average; a task's memory grows with its shard (README).
SHARD_BYTES = 2 << 20
#: Rows of one mark that a task looks at together; more of them all stay.
MARK_ROWS = 50_000
#: Bytes of text that are marked at once, which takes some 130 times as many bytes of memory.
_BLOCK = 1 << 18
#: Longer texts are marked segment by segment; a window's mark keeps 40 bits of its hash.
_SEGMENT = 1 << 20
#: Runs that leave a task in one batch.
_RUN_ROWS = 1 << 16
_PLACE_BITS = np.uint64(24)

_RUN = "mark bigint, kind int, content bigint, doc_id bigint, copy int, start int, size int, near bigint"
_RUN_SCHEMA = pa.schema([("mark", pa.int64()), ("kind", pa.int32()), ("content", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int32()), ("start", pa.int32()), ("size", pa.int32()), ("near", pa.int64())])
_WHOLE, _FIRST = 0, 1  # kind: every byte repeats; windows to be compared


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty), ``copy``, a hash that tells apart rows with the same id, and the struct ``rest`` if there is one."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rest = [docs["rest"]] if "rest" in docs.columns and isinstance(docs.schema["rest"].dataType, StructType) else []
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.hash(text).alias("copy"), text.alias("text"), *rest)


def window_runs(data: np.ndarray, bounds: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one mark: row, start in it, number of windows, mark, content hash, hash of the surroundings.

    The last joins 32 bits each of the anchor with ``(length - anchor) // 2`` bytes on its left and on its
    right: equal windows hold at least one of the two whole. 0 stands for a side that leaves its row, and -1
    as a whole for a mark that a run holds twice.
    """
    n = len(data)
    if n < length:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    bits = _PLACE_BITS
    packed = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, windows = length - anchor + 1, n - length + 1
    pad = -len(packed) % width
    tiles = np.concatenate([packed, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    mark, place = least >> bits, (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row_of = np.searchsorted(bounds, np.arange(windows), side="right") - 1
    valid = np.arange(windows) + length <= bounds[np.minimum(row_of + 1, len(bounds) - 1)]
    new = np.ones(windows, bool)
    new[1:] = (mark[1:] != mark[:-1]) | (row_of[1:] != row_of[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], windows)
    # the windows at the end of a row leave it
    good = np.concatenate([[0], np.cumsum(valid)])
    ends = starts + good[ends] - good[starts]
    starts, ends = starts[starts < ends], ends[starts < ends]
    pieces = -(-(ends - starts) // RUN)
    first = np.repeat(starts, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    last = np.minimum(first + RUN, np.repeat(ends, pieces))
    row, at = row_of[first], place[first]
    twice = at != place[last - 1]
    stop = last + length - 1
    content = mix((sums[stop] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    side = (length - anchor) // 2
    left, right = at - side, at + anchor + side
    l = mix((sums[at + anchor] - sums[np.maximum(left, 0)]) * down[np.maximum(left, 0)]) >> np.uint64(33)
    r = mix((sums[np.minimum(right, n)] - sums[at]) * down[at]) >> np.uint64(33)
    l = np.where(left >= bounds[row], l + np.uint64(1), np.uint64(0))
    r = np.where(right <= bounds[row + 1], r + np.uint64(1), np.uint64(0))
    near = np.where(twice, np.int64(-1), (l << np.uint64(32) | r).view(np.int64))
    return row, first - bounds[row], last - first, mark[first].view(np.int64), content.view(np.int64), near


def _runs_of(batch: pa.RecordBatch, length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """The runs of a batch (doc_id, copy, text); its texts are looked at ``_BLOCK`` bytes at a time and never copied as a whole."""
    ids, copies, texts = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
    known, missing = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((copies, known, ~missing))  # null ids are first in the corpus
    # a row that repeats id and text has no part in this
    again = np.zeros(len(order), bool)
    again[1:] = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (known, missing, copies)])
    order = order[~again]
    ends, parts, low = np.cumsum(pc.binary_length(texts).to_numpy()[order], dtype=np.int64), [], 0
    while low < len(order):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _BLOCK, side="right")))
        data, bounds = flat_text(texts.take(pa.array(order[low:high])))
        for at in range(0, max(len(data), 1), _SEGMENT) if len(bounds) == 2 else (0,):
            part = data[at : at + _SEGMENT + length - 1] if len(bounds) == 2 else data
            cuts = bounds if len(part) == len(data) else np.array([0, len(part)])
            row, start, count, mark, content, near = window_runs(part, cuts, length, anchor)
            if len(part) < len(data):  # what surrounds a run may lie in the next segment
                near = np.full(len(near), -1)
            parts.append([(row + low).astype(np.int32), (start + at).astype(np.int32), (count + length - 1).astype(np.int32), mark, content, near])
        low = high
    if not parts:
        return
    row, start, size, mark, content, near = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    # of equal runs in this batch the first one goes on, the others repeat it
    _, first = np.unique(content, return_index=True)
    keep = np.zeros(len(row), bool)
    keep[first] = True
    # repeats that touch are one span, sent anywhere
    span = np.flatnonzero(~keep)
    if len(span):
        a, b, r = start[span], start[span] + size[span], row[span]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (a[1:] > b[:-1])])
        at, end = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(span)) - 1
        which, zeros = order[r[at]], np.zeros(len(at), np.int64)
        yield record_batch(_RUN_SCHEMA, [mix((copies[which].astype(np.uint64) << np.uint64(32)) + a[at].astype(np.uint64)).view(np.int64), zeros.astype(np.int32), zeros, ids.take(pa.array(which)), copies[which], a[at], b[end] - a[at], zeros])
    kept = np.flatnonzero(keep)
    for low in range(0, len(kept), _RUN_ROWS):
        k = kept[low : low + _RUN_ROWS]
        which = order[row[k]]
        yield record_batch(_RUN_SCHEMA, [mark[k], np.full(len(k), _FIRST, np.int32), content[k], ids.take(pa.array(which)), copies[which], start[k], size[k], near[k]])


def _runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _runs_of(batch, length, anchor)

    return docs.select("doc_id", "copy", "text").mapInArrow(make, _RUN)


def _sift(runs: DataFrame) -> DataFrame:
    """Spans that repeat as a whole (kind 0), and the first of each run that may share windows with another (kind 1)."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, flood, before = None, None, None  # rows of a mark that may go on; a mark with too many rows; the last run
        for batch in _and_none(batches):
            table = [x for x in (kept, batch) if x is not None]
            if not table:
                return
            rows = pa.Table.from_batches(table).combine_chunks().to_batches()[0]
            mark, kind, content = (rows.column(i).to_numpy() for i in range(3))
            cut, all_of = len(mark), {flood}
            if batch is not None:
                if int(mark[-1]) != flood:  # a flooded mark stays one until its last row
                    cut, flood = int(np.searchsorted(mark, mark[-1])), None
                if len(mark) - cut > MARK_ROWS:  # its rows go on unsifted, so that no more of them wait here
                    cut, flood = len(mark), int(mark[-1])
                    all_of.add(flood)
            out, kind = kind == _WHOLE, kind.copy()
            own = np.flatnonzero(~out & (np.arange(len(mark)) < cut))
            if len(own):
                place = [mark[own], content[own], rows.column(3).fill_null(0).to_numpy()[own], rows.column(3).is_null().to_numpy(zero_copy_only=False)[own], rows.column(4).to_numpy()[own], rows.column(5).to_numpy()[own]]
                place = [np.concatenate([[x[0] if before is None else before[i]], x]) for i, x in enumerate(place)]
                equal = [x[1:] == x[:-1] for x in place]
                repeats, itself = equal[0] & equal[1], np.logical_and.reduce(equal)
                if before is None:
                    repeats[0] = itself[0] = False
                before = [x[-1] for x in place]
                out[own[repeats & ~itself]], kind[own[repeats]] = True, _WHOLE
                firsts = own[~repeats]
                out[firsts[_shared(mark[firsts], rows.column(7).to_numpy()[firsts], all_of)]] = True
            out[cut:] = False
            found = rows.take(pa.array(np.flatnonzero(out)))
            yield record_batch(_RUN_SCHEMA, [found.column(0), kind[out], *[found.column(i) for i in range(2, 8)]])
            kept = rows.slice(cut) if cut < len(mark) else None

    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("mark"), F.col("content"), F.col("doc_id").asc_nulls_first(), F.col("copy"), F.col("start")]
    return runs.repartition(tasks, "mark").sortWithinPartitions(*order).mapInArrow(sift, _RUN)


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that have rows, and the end."""
    yield from (b for b in batches if b.num_rows)
    yield None


def _shared(mark: np.ndarray, near: np.ndarray, all_of: set) -> np.ndarray:
    """Of different runs, sorted by mark: those with the anchor and one whole side in common with another run."""
    keep = np.zeros(len(mark), bool)
    n = len(mark)
    if not n:
        return keep
    group = np.cumsum(np.concatenate([[0], mark[1:] != mark[:-1]]))
    wild = np.bincount(group, weights=near == -1) > 0
    for side in (near >> 32, near & 0xFFFFFFFF):
        order = np.lexsort((side, group))
        g, s = group[order], side[order]
        equal = (g[1:] == g[:-1]) & (s[1:] == s[:-1]) & (s[1:] != 0)
        both = np.zeros(n, bool)
        both[1:] |= equal
        both[:-1] |= equal
        keep[order[both]] = True
    keep |= wild[group]  # such a run may also repeat itself
    for m in all_of - {None}:
        keep |= mark == m
    return keep


_REPEAT = "doc_id bigint, copy int, start int, size int"
_REPEAT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("copy", pa.int32()), ("start", pa.int32()), ("size", pa.int32())])


def _sorted_shards(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    """Repeated spans of the runs, a shard of marks per task; the text of a shard and its queues are on disk."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            ids, copies, starts, sizes = [], [], [], []
            path = os.path.join(folder, "text")
            with open(path, "wb") as out:
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    data, bounds = flat_text(_as_text(batch.column(4)))
                    size = np.diff(bounds)
                    # each run ends in a 1; bytes start at 2
                    text = np.ones(len(data) + len(size), np.uint16)
                    text[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data.astype(np.uint16) + 2
                    text.tofile(out)
                    ids.append(batch.column(1))
                    copies.append(batch.column(2).to_numpy())
                    starts.append(batch.column(3).to_numpy())
                    sizes.append(size)
                np.zeros(1, np.uint16).tofile(out)
            if not sizes:
                return
            size, start, copy = np.concatenate(sizes), np.concatenate(starts), np.concatenate(copies)
            ids = pa.concat_arrays(ids)
            first = np.cumsum(size + 1) - size - 1
            text = np.memmap(path, np.uint16, "r")
            repeats = np.memmap(os.path.join(folder, "repeats"), np.bool_, "w+", shape=(len(text),))
            _mark_repeats(text, suffix_array(text, length, folder), first, size, length, repeats)
            at = np.flatnonzero(repeats)
            del text, repeats
            if not len(at):
                return
            new = np.concatenate([[True], (at[1:] > at[:-1] + length)])
            row = np.searchsorted(first, at, side="right") - 1
            new[1:] |= row[1:] != row[:-1]
            low = np.flatnonzero(new)
            high = np.append(low[1:], len(at)) - 1
            row = row[low]
            yield record_batch(_REPEAT_SCHEMA, [ids.take(pa.array(row)), copy[row], (start[row] + at[low] - first[row]).astype(np.int32), (at[high] - at[low] + length).astype(np.int32)])

    rows = pieces.repartition(shards, "mark").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "copy", "start")
    return rows.mapInArrow(sort, _REPEAT)


def _as_text(column: pa.Array) -> pa.Array:
    """A binary column under the type that ``flat_text`` reads, without looking at the bytes."""
    return pa.Array.from_buffers(pa.string(), len(column), column.buffers(), column.null_count, column.offset)


def _mark_repeats(text, chunks, first: np.ndarray, size: np.ndarray, length: int, repeats) -> None:
    """Set ``repeats`` at the start of each whole window that also starts earlier in the text."""
    tail = np.empty(0, np.int64)  # the earliest start so far of a group that may go on
    for pos, lcp in chunks:
        row = np.maximum(np.searchsorted(first, pos, side="right") - 1, 0)
        whole = (pos - first[row] + length <= size[row])
        new = lcp < length
        if len(tail):
            pos, new, whole = np.concatenate([tail, pos]), np.concatenate([[True], new]), np.concatenate([[True], whole])
        starts = np.flatnonzero(new) if new[0] else np.concatenate([[0], np.flatnonzero(new)])
        least = np.minimum.reduceat(pos, starts)
        group = np.cumsum(new) - (1 if new[0] else 0)
        later = whole & (pos != least[group])
        repeats[pos[later]] = True
        tail = least[-1:] if whole[-1] else np.empty(0, np.int64)


def _by_document(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans (mark, start, size) followed by their documents (packed), all of a document in one task.

    One shuffle brings both together, whatever repeats or is null among the ids.
    """
    none = F.lit(None)
    left = spans.select("doc_id", "copy", F.lit(0).alias("kind"), "mark", "start", "size", none.cast("binary").alias("packed"), none.cast(docs.schema["rest"].dataType if "rest" in docs.columns else "int").alias("rest"))
    right = _packed(docs).select("doc_id", "copy", F.lit(1).alias("kind"), none.cast("bigint").alias("mark"), none.cast("int").alias("start"), none.cast("int").alias("size"), "packed", "rest" if "rest" in docs.columns else none.cast("int").alias("rest"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.unionByName(right).repartition(tasks, "doc_id", "copy").sortWithinPartitions("doc_id", "copy", "kind")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, copy, which of the rows with these, spans as three lists, rest, text) of rows dealt by ``_by_document``."""
    import zstandard

    unpacker, key, number = zstandard.ZstdDecompressor(), None, 0
    found: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for i, (doc, copy, kind, mark, start, size) in enumerate(zip(*columns)):
            if (doc, copy) != key:
                key, number, found = (doc, copy), 0, ([], [], [])
            if kind == 0:
                for values, value in zip(found, (mark, start, size)):
                    values.append(value)
            else:
                number += 1
                yield doc, copy, number, found, batch.column(7)[i].as_py(), unpacker.decompress(batch.column(6)[i].as_py())


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, cut by the bytes of their last column."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1]) + 64
        if weight > size:
            yield record_batch(schema, [list(x) for x in zip(*held)])
            held, weight = [], 0
    if held:
        yield record_batch(schema, [list(x) for x in zip(*held)])


def _pieces(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The bytes of each run, cut from its document."""
    schema = pa.schema([("mark", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int32()), ("start", pa.int32()), ("piece", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(((mark, doc, copy, a, text[a : a + n]) for doc, copy, number, found, _, text in _documents(batches) if number == 1 for mark, a, n in zip(*found)), schema)

    return _by_document(docs, runs).mapInArrow(cut, "mark bigint, doc_id bigint, copy int, start int, piece binary")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, copy, and the text compressed, which is what the two joins by document shuffle."""
    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for low, high, data, bounds in text_blocks(batch.column(2)):
                packed = [packer.compress(data[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary()), *part.columns[3:]], names=["doc_id", "copy", "packed", *part.schema.names[3:]])

    return docs.mapInArrow(squeeze, _with_rest("doc_id bigint, copy int, packed binary", docs))


def _with_rest(names: str, docs: DataFrame) -> StructType:
    schema = StructType.fromDDL(names)
    return schema.add(docs.schema["rest"]) if "rest" in docs.columns else schema


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, copy, start, size) of spans of bytes covered by repeats; spans of a document may overlap."""
    rows = keyed(docs)
    sifted = cut_lineage(_sift(_runs(rows, length, anchor)))
    spans = sifted.where(F.col("kind") == _WHOLE).select("doc_id", "copy", "start", "size")
    rims = sifted.where(F.col("kind") == _FIRST)
    total = rims.agg(F.sum("size")).first()[0] or 0
    if total:
        shards = int(total // SHARD_BYTES) + 1
        spans = spans.unionByName(_sorted_shards(_pieces(rows, rims), shards, length))
    return spans


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, copy, number, n_bytes, what is left (``kept``, ``text``), and ``spans``: the removed (start, end), maximal and in order.

    A byte goes when a string of ``length`` bytes that covers it also starts earlier in the corpus: in a
    smaller doc_id, or in the same document further left. Strings are judged on the input, and never cross
    documents. Null text is empty; null ids come before all others. Rows that share an id are ordered by a
    hash of their text (``copy``), and of rows that repeat id and text one is the first (``number`` 1): the
    others repeat it, and lose everything if they have ``length`` bytes. Cutting may part a character; bytes
    that are then no UTF-8 stay as they are in ``kept``, and become the replacement character in ``text``.
    A struct column ``rest`` goes along; without one it is null.
    An empty table gives no rows.
    """
    rows = keyed(docs)
    extra = rows.schema["rest"].dataType if "rest" in rows.columns else IntegerType()
    spark_schema = StructType.fromDDL("doc_id bigint, copy int, number int, n_bytes bigint, spans array<struct<start:int,end:int>>").add("rest", extra).add("kept", "binary")
    schema = to_arrow_schema(spark_schema)
    spans = cut_lineage(repeated_spans(docs, length)).withColumn("mark", F.lit(0).cast("bigint"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc, copy, number, (_, start, size), rest, text in _documents(batches):
                if number > 1:
                    merged = [(0, len(text))] if len(text) >= length else []
                else:
                    merged = _merged(np.array(start, np.int64), np.array(size, np.int64))
                edges = [0, *[x for span in merged for x in span], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                yield doc, copy, number, len(text), [{"start": a, "end": b} for a, b in merged], rest, kept

        yield from _batched(rows(), schema)

    rows = _by_document(rows, spans).mapInArrow(cut, spark_schema)
    return rows.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))


def _merged(start: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans as maximal runs of bytes."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order].astype(np.int64), np.maximum.accumulate((start + size)[order].astype(np.int64))
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return list(zip(start[new].tolist(), end[last].tolist()))
