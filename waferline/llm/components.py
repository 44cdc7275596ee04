"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.session import cut_lineage

#: So many links at most are settled by one task (16 bytes a link); more go through turns of joins.
FEW_LINKS = 100_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); the root is the smallest node of its component.

    Large and small stars by turns: first every node hands its larger neighbours to its smallest one, then
    every node hands its smaller neighbours and itself to the smallest. Each turn is two joins of links with
    one minimum per node, so a node with very many links is only a skewed join side. The links of a turn
    are written to the shared folder; the turns end when a turn changes nothing, after a number that grows
    with the logarithm of the longest path. Links of a node with itself and repeated links change nothing;
    no links give no rows.
    """
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = cut_lineage(links.where("a <> b").distinct())
    state = _state(links)
    if state[0] <= FEW_LINKS:
        return links.coalesce(1).mapInArrow(_joined, "node bigint, root bigint")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        large = cut_lineage(large)
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m"), "a", "b")
        small = small.select(F.col("m").alias("a"), "b").unionByName(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
        links = cut_lineage(small.where("a <> b").distinct())
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of a few links, read by one task."""
    above: dict[int, int] = {}

    def root(node: int) -> int:
        while above[node] != node:
            above[node] = above[above[node]]
            node = above[node]
        return node

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            above.setdefault(a, a)
            above.setdefault(b, b)
            x, y = root(a), root(b)
            above[max(x, y)] = min(x, y)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], ["node", "root"])
