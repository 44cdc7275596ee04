"""SimHash fingerprints of documents, and a search for all fingerprints within a Hamming radius.

Terms are the runs of ``TERM_WORDS`` words, weighted by how often they occur; a term's 128-bit hash votes on
each bit with its weight, and the sign of the sum is the bit. For the search a fingerprint is cut into
blocks, some more than the radius: two fingerprints within it agree on enough whole blocks, so each choice
of that many blocks is a table (a permutation that brings these blocks to the front), and only fingerprints
that agree there are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import documents, record_batch, text_blocks
from waferline.llm.words import LOWER, mix, shingle_runs, spans, word_hashes

BITS = 128
TERM_WORDS = 3
RADIUS = 3
#: Blocks of a fingerprint beyond the radius; two within the radius agree on so many.
SPARE_BLOCKS = 2
_TERMS = 1 << 16


def fingerprints(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit halves for each text; A-Z count as a-z, a text of fewer words is one term, no words give 0."""
    low = LOWER[data]
    starts, ends, counts = spans(low, bounds)
    terms, cuts = shingle_runs(word_hashes(low, starts, ends), counts, TERM_WORDS)
    votes = np.zeros((len(bounds) - 1, BITS), np.int32)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(cuts))
    for at in range(0, len(terms), _TERMS):
        part, own = terms[at : at + _TERMS], row[at : at + _TERMS]
        both = np.stack([mix(part + np.uint64(0xA5A5)), mix(part + np.uint64(0x1234567))], axis=1)
        bits = np.unpackbits(both.view(np.uint8), axis=1, bitorder="little")
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        # a term that occurs twice votes twice
        votes[own[first]] += 2 * np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    votes -= np.diff(cuts).astype(np.int32)[:, None]
    return np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64)


def to_hex(prints: np.ndarray) -> list[str]:
    return [f"{b:016x}{a:016x}" for a, b in prints.tolist()]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def add_fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and ``fingerprint`` (32 hexadecimal digits) of every whole text, null as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in text_blocks(batch.column(1)):
                yield record_batch(schema, [batch.column(0).slice(low, high - low), to_hex(fingerprints(data, bounds))])

    return documents(docs).mapInArrow(make, "doc_id bigint, fingerprint string")


def within_radius(prints: DataFrame, radius: int = RADIUS, spare: int = SPARE_BLOCKS) -> DataFrame:
    """(a, b, distance) for all pairs of different fingerprints at most ``radius`` bits apart.

    ``prints`` has a column ``fingerprint``; equal ones are one, so copies cost nothing and make no pairs
    (a join on the fingerprint brings the documents back). Bits are cut into ``radius + spare`` blocks; each
    choice of ``spare`` of them is a table. A pair that agrees on more than one choice is found in the first
    table only. Null fingerprints have no partner. Blocks shared by very many fingerprints are a skewed join
    side, which adaptive execution splits.
    """
    blocks = radius + spare
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    distinct = prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct()
    bits = F.concat(*[F.lpad(F.conv(F.substring("fingerprint", i * 8 + 1, 8), 16, 2), 32, "0") for i in range(BITS // 32)])
    cut = distinct.withColumn("bits", bits)
    cut = cut.select("fingerprint", "bits", *[F.substring("bits", edges[i] + 1, edges[i + 1] - edges[i]).alias(f"block{i}") for i in range(blocks)])
    tables = list(combinations(range(blocks), spare))
    keys = F.array(*[F.concat_ws("-", F.lit(str(t)), *[F.col(f"block{i}") for i in chosen]) for t, chosen in enumerate(tables)])
    rows = cut.select("fingerprint", "bits", F.posexplode(keys).alias("number", "key"))
    l, r = rows.alias("l"), rows.alias("r")
    apart = F.length(F.translate(F.concat(*[F.lpad(F.conv(F.conv(F.substring("l.fingerprint", i * 8 + 1, 8), 16, 10).cast("bigint").bitwiseXOR(F.conv(F.substring("r.fingerprint", i * 8 + 1, 8), 16, 10).cast("bigint")).cast("string"), 10, 2), 32, "0") for i in range(BITS // 32)]), "0", ""))
    pairs = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.fingerprint") < F.col("r.fingerprint")))
    same = [F.substring("l.bits", edges[i] + 1, edges[i + 1] - edges[i]) == F.substring("r.bits", edges[i] + 1, edges[i + 1] - edges[i]) for i in range(blocks)]
    earliest = F.coalesce(*[F.when(_all([same[i] for i in chosen]), F.lit(t)) for t, chosen in enumerate(tables)])
    pairs = pairs.where(F.col("l.number") == earliest)
    return pairs.select(F.col("l.fingerprint").alias("a"), F.col("r.fingerprint").alias("b"), apart.cast("int").alias("distance")).where(F.col("distance") <= radius)


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, of an edited form of it, and of the next document.

    In the edited form the last quarter of the code points (rounded down) is replaced by as many from the
    start of the next document, or all it has. Next is the next row by doc_id (null first), then by text;
    after the last comes the first, so a single row follows itself. Null text is empty.

    Rows are dealt out by ranges of doc_id, and each range also gets the first row of the next one, so one
    shuffle brings every row to its neighbour. The ranges' bounds are approximate quantiles of doc_id.
    Columns: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("edited_text", pa.string())])
    spark = docs.sparkSession
    rows = documents(docs).withColumn("text", F.coalesce("text", F.lit("")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / tasks for i in range(1, tasks)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", shares or [0.5], 10_000)).first()[0] or []))
    rows = rows.withColumn("place", F.col("doc_id").cast("double"))
    if bounds:
        splits = [-float("inf"), *sorted({float(b) for b in bounds}), float("inf")]
        rows = Bucketizer(splits=splits, inputCol="place", outputCol="part", handleInvalid="keep").transform(rows)
        rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("part")).cast("int"))
    else:
        rows = rows.withColumn("part", F.lit(0))
    # the smallest id of each range; a null one comes before all others
    firsts = rows.groupBy("part").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")).orderBy("part").collect()
    guests = [(None if own["nulls"] else own["least"], firsts[i - 1]["part"]) for i, own in enumerate(firsts)]
    guests = F.broadcast(spark.createDataFrame(guests, "first bigint, before int"))  # a row per range
    rows = rows.join(guests, rows["doc_id"].eqNullSafe(guests["first"]), "left")
    own = F.struct(F.col("part").alias("to"), F.lit(0).alias("guest"))
    twice = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("to"), F.lit(1).alias("guest"))))
    dealt = rows.select("doc_id", "text", F.inline(twice)).repartition(tasks, "to").sortWithinPartitions("to", "guest", F.col("doc_id").asc_nulls_first(), "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows whose next one is known
        last, size = None, 0
        for batch in batches:
            for doc, text, to, guest in zip(*[c.to_pylist() for c in batch.columns]):
                if last is not None and last[2] == to:
                    held.append((last[0], last[1], text))
                    size += len(last[1])
                last = None if guest else (doc, text, to)  # only the first guest is needed: the next row of the range's last
                if size > 1 << 20 or len(held) >= 5000:
                    yield compared(held)
                    held, size = [], 0
        if held:
            yield compared(held)

    def prints(texts: list[str]) -> np.ndarray:
        return np.concatenate([fingerprints(d, b) for _, _, d, b in text_blocks(pa.array(texts, pa.string()))])

    def compared(held: list[tuple]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for _, t, n in held]
        own, new = prints([t for _, t, _ in held]), prints(edited)
        # the next row of each is mostly the following one
        odd = [i for i in range(len(held)) if i + 1 == len(held) or held[i + 1][1] != held[i][2]]
        after = np.concatenate([own[1:], own[:1]])
        if odd:
            after[odd] = prints([held[i][2] for i in odd])
        return record_batch(schema, [[d for d, _, _ in held], [len(t) for _, t, _ in held], to_hex(own), to_hex(new), likeness(own, new), likeness(own, after), edited])

    return dealt.select("doc_id", "text", "to", "guest").mapInArrow(make, "doc_id bigint, n_chars bigint, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_text string")
