"""Exact top-k inner products by aggregation of sorted lists without random access.

Per block of candidates, each dimension is a list sorted by value. All queries of a block read all lists
together, from the top where the query's component is positive and from the bottom where it is negative.
What has been read of a candidate is its known part; the frontier of each list bounds the rest from above,
the list's far end from below. A candidate falls for a query when its upper bound is under the lower bounds
of k others of its block, or under the k scores that the blocks before have given; those that remain are
scored exactly. At a given depth the bounds of all pairs are one matrix product: a value that has been read
stands for itself, any other one for the frontier, so the values are cut off at the frontier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import record_batch
from waferline.session import cut_lineage

#: Candidates whose lists are sorted together, and queries that read them together.
BLOCK_ROWS = 1024
BLOCK_QUERIES = 512
#: Shares of the lists after which the bounds are compared, while more than ``FEW`` of the pairs are left.
DEPTHS = (0.75, 0.9, 1.0)
FEW = 1 / 64
#: Components of candidates that a task holds at most; it holds ``SHARD_ROWS`` candidates at least, if there are.
SHARD_VALUES = 1 << 23
SHARD_ROWS = 1024
#: Whole numbers below it, their products and sums are exact in 32-bit floating point.
EXACT = 1 << 24
#: Stands for a null id in blocks, and sorts last.
NO_ID = 1 << 62


def read_lists(x: np.ndarray, lists: np.ndarray, q: np.ndarray, bar: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that may be among the k best, of queries ``q`` over candidates ``x``.

    ``lists`` holds each dimension of ``x`` by ascending value, ``bar`` for each query a score that one of the
    k best has at least (-inf where none is known). Of each query every candidate that is not in the result is
    under its bar, or has k others with a higher score.
    """
    n = len(x)
    sides = np.hstack([np.maximum(q, 0), np.minimum(q, 0)]).T
    slack = 0 if x.dtype == np.float32 else 1e-12 * np.abs(q).sum(axis=1) * np.abs(lists[[0, -1]]).max()  # more than rounding can take
    for share in DEPTHS:
        to = max(1, int(np.ceil(share * n)))
        top, low = lists[n - to], lists[to - 1]
        most = np.hstack([np.maximum(x, top), np.minimum(x, low)]) @ sides
        if n > k and np.isinf(bar).any():
            least = most if to == n else np.hstack([np.where(x >= top, x, lists[0]), np.where(x <= low, x, lists[-1])]) @ sides
            bar = np.maximum(bar, np.partition(least, n - k, axis=0)[n - k] - slack)
        may = most >= bar - slack
        if np.count_nonzero(may) <= FEW * may.size:
            break
    candidate, query = np.divmod(np.flatnonzero(may), len(q))
    return query, candidate


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows of 64-bit integers; an error where one doesn't fit 64 bits."""
    score = np.einsum("ij,ij->i", x, q)  # modulo 2**64, so right wherever the sum itself fits
    most = np.einsum("ij,ij->i", np.abs(x.astype(np.float64)), np.abs(q.astype(np.float64)))
    for i in np.flatnonzero(most >= 2.0**62):
        if sum(a * b for a, b in zip(x[i].tolist(), q[i].tolist())) != int(score[i]):
            raise OverflowError("an inner product doesn't fit 64 bits")
    return score


def pair_scores(x: np.ndarray, q: np.ndarray, candidate: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The scores of pairs; vectors come as 32-bit floating point only where that is exact."""
    score = np.empty(len(query), np.int64)
    for at in range(0, len(query), 20_000):
        to = slice(at, at + 20_000)
        left, right = x[candidate[to]], q[query[to]]
        score[to] = np.einsum("ij,ij->i", left, right) if x.dtype == np.float32 else exact_scores(left, right)
    return score


class Shard:
    """The candidates of one task, in blocks with their sorted lists."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, block_rows: int):
        self.blocks = []
        for at in range(0, len(x), block_rows):
            part = x[at : at + block_rows]
            bounded = part if x.dtype == np.float32 else part.astype(np.float64)
            self.blocks.append((part, bounded, np.sort(bounded, axis=0), ids[at : at + block_rows], rows[at : at + block_rows]))

    def top(self, q: np.ndarray, q_rows: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The k best of all blocks for each query: query, candidate row, candidate id, score; a query's own row is left out."""
        bounded = q if q.dtype == np.float32 else q.astype(np.float64)
        best = tuple(np.empty(0, np.int64) for _ in range(4))
        bar, bound = np.full(len(q), np.iinfo(np.int64).min), np.full(len(q), -np.inf, bounded.dtype)
        for x, values, lists, ids, rows in self.blocks:
            # one more than k, since a query may meet itself
            query, candidate = read_lists(values, lists, bounded, bound, k + 1)
            score = pair_scores(x, q, candidate, query)
            keep = (score >= bar[query]) & (q_rows[query] != rows[candidate])
            query, candidate, score = query[keep], candidate[keep], score[keep]
            if not len(query):
                continue
            query, row, id_, score = (np.concatenate(c) for c in zip(best, (query, rows[candidate], ids[candidate], score)))
            order = np.lexsort((row, id_, ~score, query))
            query = query[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            query, order, place = query[place < k], order[place < k], place[place < k]
            best = query, row[order], id_[order], score[order]
            full = place == k - 1
            bar[query[full]] = best[3][full]
            bound[query[full]] = best[3][full]
        return best


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Vectors as rows, with zeros beyond their end."""
    values, size = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return values.reshape(len(column), width).astype(kind)
    out = np.zeros((len(column), width), kind)
    ends = np.cumsum(size)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(ends - size, size)] = values
    return out


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """row_id, vec_id and x = floor(scale * component); vectors that are null or hold a null or non-finite component go.

    Null ids stay candidates. A scaled component that doesn't fit 64 bits is an error.
    """
    part = F.transform(F.col(vector_column), lambda v: v.cast("double"))
    finite = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), part.alias("v")).where(F.col("v").isNotNull() & finite)
    fits = lambda v: F.when(F.abs(F.lit(float(scale)) * v) < 2.0**63, v).otherwise(F.raise_error(F.lit("a scaled component doesn't fit 64 bits")).cast("double"))
    x = F.transform("v", lambda v: F.floor(F.lit(float(scale)) * fits(v)).cast("bigint"))
    return rows.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", x.alias("x"))


def _measured(rows: DataFrame) -> tuple[int, int, int]:
    """How many vectors there are, the longest one's size, and the largest component's absolute value."""
    row = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high")).first()
    return row["n"], row["width"] or 0, max(-(row["low"] or 0), row["high"] or 0, 0)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest integer inner products over all other rows.

    Both tables have row_id, vec_id, x (integers). Ties go to the smaller vec_id (null last), then to the
    smaller row_id; a query is left out of its own candidates by row, so rows that repeat it stay. A vector
    shorter than the longest counts as zero beyond its end. Candidates are dealt to shards by a hash of their
    row; a task holds one shard, the queries pass by it block by block, and it gives ``k`` rows a query; with
    fewer candidates all are returned. Queries are exchanged once for each shard, candidates once. An empty
    table gives no rows.
    """
    queries = cut_lineage(queries.select("row_id", "vec_id", "x"))
    (n, width, most), (many, longest, largest) = _measured(rows), _measured(queries)
    width = max(width, longest, 1)
    kind = np.float32 if width * most * largest < EXACT and max(most, largest) < EXACT else np.int64
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = min(tasks, -(-n // SHARD_ROWS), max(32, 2 * n // max(many, 1)))
    shards = max(1, spread, -(-n * width // SHARD_VALUES))
    block_rows, block_queries = BLOCK_ROWS, BLOCK_QUERIES
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    names = "query_row bigint, query_id bigint, vec_row bigint, vec_id bigint, score bigint"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, held = None, None, {0: [], 1: []}

        def taken(kind_: int) -> tuple[np.ndarray, ...]:
            parts, held[kind_] = held[kind_], []
            return tuple(np.concatenate(c) for c in zip(*parts))

        def answers() -> Iterator[pa.RecordBatch]:
            if held[1]:
                q_rows, q_ids, q = taken(1)
                for low in range(0, len(q) if shard else 0, block_queries):
                    to = slice(low, low + block_queries)
                    query, row, id_, score = shard.top(q[to], q_rows[to], k)
                    yield record_batch(schema, [q_rows[to][query], q_ids[to][query], row, id_, score])

        for batch in batches:
            numbers, sides = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(sides) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if low == high:
                    continue
                if numbers[low] != at:
                    yield from answers()
                    at, shard, held = int(numbers[low]), None, {0: [], 1: []}
                side, part = int(sides[low]), batch.slice(low, high - low)
                # copies, which don't keep the batch
                held[side].append((np.array(part.column(2)), np.array(part.column(3)), matrix(part.column(4), width, kind)))
                if side and held[0]:
                    row, id_, x = taken(0)
                    shard = Shard(x, id_, row, block_rows)
                if side and sum(len(p[0]) for p in held[1]) >= block_queries:
                    yield from answers()
        yield from answers()

    given, asked = (
        t.select(place.alias("shard"), F.lit(side).alias("side"), "row_id", F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"), "x")
        for t, side, place in (
            (rows, 0, F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int")),
            # the stated queries, all of them for every shard of candidates
            (queries, 1, F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))),
        )
    )
    dealt = given.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "side")
    found = dealt.mapInArrow(search, names)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return ranked.select(back("query_id"), F.col("rank").cast("int").alias("rank"), back("vec_id"), "score")
