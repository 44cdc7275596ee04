"""Near-duplicate documents by MinHash bands, with odd sketches in front of the exact comparison.

Each distinct set of word shingles gets ``BANDS * ROWS`` MinHash samples. Sets that agree on all samples of a
band meet in its bucket. All samples are also folded into an odd sketch, a bitmap in which every (sample
number, value) flips one bit: where two sketches differ, an odd number of samples differs, so the number of
set bits of their XOR tells how many samples are not shared, the more precisely the more similar the sets.
Candidates whose sketches differ too much are dropped unseen; the others are confirmed on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import documents, record_batch, text_blocks
from waferline.llm.components import components
from waferline.llm.jaccard import PERCENT, differing_bits, labelled, link_up, may_link, members, parity_of, set_ids
from waferline.llm.words import mix, text_sets
from waferline.session import cut_lineage

SHINGLE_WORDS = 2
#: Two sets of similarity 0.8 share no bucket with odds of (1 - 0.8**ROWS)**BANDS, about 5 in 10 million.
BANDS, ROWS = 48, 6
#: Bits of a sketch, in 64-bit words.
SKETCH_WORDS = 8
#: A pair at the threshold is dropped only if its samples miss their mean by so many standard deviations.
DEVIATIONS = 5
#: Shingles whose samples are taken together.
_STRETCH = 1 << 14
_U = np.uint64


def _factors(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)


def samples(values: np.ndarray, bounds: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """The MinHash samples of each non-empty stretch of distinct hashes: a row a stretch, a column a sample."""
    starts = bounds[:-1]
    out = np.empty((len(starts), count), np.uint32)
    factors = _factors(count)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + _STRETCH, side="right")) - 1)
        part, at = values[bounds[low] : bounds[high]], starts[low:high] - bounds[low]
        for k, factor in enumerate(factors):
            out[low:high, k] = np.minimum.reduceat(part * factor, at) >> _U(32)
        low = high
    return out


def band_keys(found: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A key for each band of samples; the band's number is in it."""
    rows = found.shape[1] // bands
    keys = np.broadcast_to(np.arange(bands, dtype=_U), (len(found), bands)).copy()
    for k in range(rows):
        keys = mix(keys * _U(0x9E3779B97F4A7C15) + found[:, k::rows].astype(_U) + _U(k))
    return keys.view(np.int64)


def odd_sketches(found: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """The samples of each row folded into a bitmap of ``words`` 64-bit words by parity."""
    number = np.arange(found.shape[1], dtype=_U)
    place = mix(found.astype(_U) + (number << _U(32))) % _U(64 * words)
    times = np.zeros((len(found), 64 * words), np.uint8)
    np.add.at(times, (np.repeat(np.arange(len(found)), found.shape[1]), place.ravel().astype(np.int64)), 1)
    return np.packbits(times & 1, axis=1, bitorder="little").view(np.int64)


def most_different_bits(percent: int = PERCENT, count: int = BANDS * ROWS, words: int = SKETCH_WORDS) -> int:
    """So many bits may the sketches of two sets differ in that are linked.

    The samples that differ are binomial; each puts two flips on the bitmap, and m flips over b bits leave
    b / 2 * (1 - exp(-2 m / b)) of them set, which itself varies by less than its root.
    """
    apart = 1 - percent / 100
    differing = count * apart + DEVIATIONS * sqrt(count * apart * (1 - apart))
    bits = 64 * words
    expected = bits / 2 * (1 - exp(-4 * differing / bits))
    return int(expected + sqrt(expected)) + 1


def sketched_sets(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(set_id, n, sketch, keys) of all non-empty sets; equal sets of one batch give one row."""
    schema = pa.schema([("set_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))])

    def lists(rows: np.ndarray) -> pa.Array:
        bounds = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
        return pa.ListArray.from_arrays(bounds, pa.array(rows.ravel()))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in text_blocks(batch.column(0)):
                values, cuts = text_sets(data, bounds, words)
                n, ids = np.diff(cuts), set_ids(values, cuts)
                _, first = np.unique(ids, return_index=True)
                fresh = np.zeros(len(n), bool)
                fresh[first] = True
                fresh &= n > 0
                if not fresh.any():
                    continue
                own = values[np.repeat(fresh, n)]
                found = samples(own, np.concatenate([[0], np.cumsum(n[fresh])]))
                yield record_batch(schema, [ids[fresh], n[fresh], lists(odd_sketches(found)), lists(band_keys(found))])

    return documents(docs).select("text").mapInArrow(make, "set_id bigint, n bigint, sketch array<bigint>, keys array<bigint>")


def _sizes_fit(left: str, right: str, percent: int) -> Column:
    return F.expr(f"100 * least({left}, {right}) >= {percent} * greatest({left}, {right})")


def _star_pairs(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared): each set with the least one of each of its buckets, where the sketches allow a link."""
    stars = met.where("set_id <> hub").select(F.col("hub").alias("a"), F.col("set_id").alias("b")).distinct()
    left, right = (sets.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    both = stars.join(left, "a").join(right, "b").where(_sizes_fit("n_a", "n_b", percent))
    both = both.withColumn("shared", -differing_bits("sketch_a", "sketch_b", SKETCH_WORDS))
    return both.where(F.col("shared") >= -most_different_bits(percent)).select("a", "b", "shared")


def _rest(met: DataFrame, sets: DataFrame, parity: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared): pairs of a bucket that are in different components, where the sketches allow a link.

    In each bucket the sets outside of its largest component meet all those of other components. The
    sketches are compared inside the join, then the parity bitmaps of the sets themselves, which rule out no
    link, and a pair comes out of the first bucket that it shares only.
    """
    roots = classes.select(F.col("node").alias("set_id"), "root")
    rows = met.select("key", "set_id").join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    rows = cut_lineage(rows)
    groups = rows.groupBy("key", "root").agg(F.count("*").alias("many"))
    main = groups.groupBy("key").agg(F.max_by("root", F.struct("many", "root")).alias("main"), F.count("*").alias("groups"))
    mixed = rows.join(main.where("groups > 1").select("key", "main"), "key")
    mixed = cut_lineage(mixed)
    held = mixed.groupBy("set_id").agg(F.collect_set("key").alias("held"))  # at most one key a band
    mixed = mixed.join(held, "set_id").join(sets.select("set_id", "n", "sketch"), "set_id").join(parity, "set_id")
    l, r = mixed.where("root <> main").alias("l"), mixed.alias("r")
    once = F.expr("r.root = r.main OR l.set_id < r.set_id")
    on = F.expr("l.key = r.key AND l.root <> r.root") & once & may_link("l", "r", percent)
    on = on & (differing_bits("l.sketch", "r.sketch", SKETCH_WORDS) <= most_different_bits(percent))
    on = on & F.expr("array_min(array_intersect(l.held, r.held)) = l.key")
    met = l.join(r, on)
    return met.select(F.least("l.set_id", "r.set_id").alias("a"), F.greatest("l.set_id", "r.set_id").alias("b"), (-differing_bits("l.sketch", "r.sketch", SKETCH_WORDS)).alias("shared")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, set_id of every row.

    Sets are the distinct shingles of ``words`` words, A-Z as a-z; a shorter text is one shingle, and one
    without words (or null) has an empty set, which is linked with nothing and is its own component.
    Sets are linked when shared shingles are at least ``percent`` in a hundred of all of both; every link is
    confirmed on the full sets. Only a pair that shares no bucket, or whose samples are far off their mean,
    is missed: at the threshold with odds of 1 in a million, above it far less.
    ``component_id`` is the smallest doc_id that links reach, and ``kept`` whether it is the row's own; rows
    that repeat a doc_id are kept together. Equal sets are one set, so copies cost nothing more. A null doc_id
    stays null, lends no id to its component and is kept only if it has no other id there.

    First every set is compared with the least of each bucket. Then only buckets whose sets are still in
    different components are gone through, and only pairs that the sketches allow are compared.
    """
    rows = cut_lineage(members(docs, words))
    sets = cut_lineage(sketched_sets(docs, words).dropDuplicates(["set_id"]))
    buckets = sets.select("set_id", F.explode("keys").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("last"))
    met = cut_lineage(buckets.join(hubs.where("hub < last").select("key", "hub"), "key"))
    pairs = cut_lineage(_star_pairs(met, sets, percent))
    none = pairs.select("a", "b").limit(0)
    classes = link_up(docs, rows, pairs, cut_lineage(components(none)), words, percent)
    more = _rest(met, sets, parity_of(rows), classes, percent).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    classes = link_up(docs, rows, cut_lineage(more), classes, words, percent)
    found = labelled(rows, classes)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
