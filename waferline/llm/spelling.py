"""Groups of spelling variants: words that differ by one character, found through PartEnum signatures.

A word is the set of its (letter, how often it came before) pairs, a binary vector. One inserted, deleted or
replaced character puts two such vectors at a Hamming distance of one or two. The coordinates are dealt to
``PARTS`` parts by a hash; vectors at distance d agree on all but d parts at most, so a signature is
the content of all parts but d chosen ones, for each choice. Words of one length are a replacement apart
(d = 2) and words whose lengths differ by one an insertion (d = 1), so lengths are in the signature too.
Equal signatures are joined, and every pair is verified by its edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import documents, record_batch
from waferline.llm.words import mix
from waferline.session import cut_lineage

#: Parts of the coordinates; a word has C(PARTS, 2) + 2 * PARTS signatures.
PARTS = 8
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form is so many times as frequent as its variant.
TIMES = 5
#: One occurrence in so many, by a hash, loses a character.
SLIP = 199
#: Different words that a task counts before it passes the counts on.
HELD_WORDS = 500_000
_RUN = re.compile("[a-zÀ-ÿ]+")
_U = np.uint64


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of ``LEAST_LETTERS`` code points that occur ``LEAST_COUNT`` times or more.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF in whole texts, with A-Z as a-z. Where the
    crc32 of ``doc_id:run`` is divisible by ``SLIP`` the run loses the code point at that crc32 modulo its
    length. A null text has no words, a null doc_id reads as empty, and repeated rows count each time.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = Counter(_RUN.findall((text or "").encode().lower().decode()))  # bytes: A-Z only
                begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, times in runs.items():
                    h = zlib.crc32(run.encode(), begun)
                    if h % SLIP == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= LEAST_LETTERS:
                        total[run] += times
            if len(total) > HELD_WORDS:
                yield record_batch(schema, [list(total), list(total.values())])
                total.clear()
        yield record_batch(schema, [list(total), list(total.values())])

    found = documents(docs).mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _parts(words: list[str], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word and part, the sum of its coordinates' hashes there, and the words' lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(_U)
    row = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((letters, row))
    letters, row = letters[order], row[order]
    new = np.ones(len(letters), bool)
    new[1:] = (letters[1:] != letters[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(new)
    before = np.arange(len(letters)) - np.repeat(starts, np.diff(np.append(starts, len(letters))))
    coordinate = mix(letters * _U(1 << 32) + before.astype(_U) + _U(1))
    sums = np.zeros((len(words), parts), _U)
    np.add.at(sums, (row, (coordinate % _U(parts)).astype(np.int64)), mix(coordinate))
    return sums, size


def signatures(words: list[str], parts: int = PARTS) -> np.ndarray:
    """The signatures of each word, a row a word; which parts are left out and the lengths are in each."""
    sums, size = _parts(words, parts)
    total, n = sums.sum(axis=1, dtype=_U), size.astype(_U)
    out = []
    for left in combinations(range(parts), 2):
        out.append(mix(mix(total - sums[:, left[0]] - sums[:, left[1]]) + n * _U(4096) + _U(left[0] * parts + left[1])))
    for part in range(parts):
        rest = mix(total - sums[:, part])
        for shorter in (n, n - _U(1)):  # with a longer word and with a shorter one
            out.append(mix(rest + shorter * _U(4096) + _U(2048 + part)))
    return np.stack(out, axis=1).view(np.int64)


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, a_n, b, b_n), a < b: all pairs of distinct words that differ by exactly one code point.

    The join's output is verified pairs only. A pair meets in as many signatures as there are choices of
    parts around its difference, and is kept once.
    """
    schema = pa.schema([("signature", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                found = signatures(part.column(0).to_pylist(), parts)
                which = pa.array(np.repeat(np.arange(part.num_rows), found.shape[1]))
                yield record_batch(schema, [found.ravel(), part.column(0).take(which), part.column(1).take(which)])

    signed = cut_lineage(words.select("word", "n").mapInArrow(sign, "signature bigint, word string, n bigint"))
    shared = signed.groupBy("signature").agg(F.count("*").alias("many")).where("many > 1").select("signature")
    signed = signed.join(shared, "signature", "left_semi")
    l, r = signed.alias("l"), signed.alias("r")
    near = (F.col("l.signature") == F.col("r.signature")) & (F.col("l.word") < F.col("r.word")) & (F.levenshtein(F.col("l.word"), F.col("r.word"), 1) == 1)
    return l.join(r, near).select(F.col("l.word").alias("a"), F.col("l.n").alias("a_n"), F.col("r.word").alias("b"), F.col("r.n").alias("b_n")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following the forms ends. Each round doubles the steps taken.

    A form is ``TIMES`` times as frequent as its word, so paths have no cycles and at most 27 steps.
    """
    steps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        after = steps.select(F.col("word").alias("at"), F.col("root").alias("further"))
        rows = cut_lineage(steps.join(after, steps["root"] == after["at"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        steps = rows.select("word", "root")
        if rows.where("moved").isEmpty():
            return steps


def variant_groups(docs: DataFrame, parts: int = PARTS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that ``word_counts`` finds.

    ``n_near`` counts the other words one inserted, deleted or replaced code point away. ``form`` is the most
    frequent of them (ties: the smallest by code points) if it occurs at least ``TIMES`` times as often as
    the word, else null, as is ``form_n``. ``root`` is where the forms lead, the word itself without one.
    A table without such words gives no rows.
    """
    words = cut_lineage(word_counts(docs))
    pairs = cut_lineage(near_pairs(words, parts))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")))
    found = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"), F.max("a_n").alias("own"))
    takes = -F.col("best.n") >= TIMES * F.col("own")
    found = cut_lineage(found.select("word", "n_near", F.when(takes, F.col("best.word")).alias("form"), F.when(takes, -F.col("best.n")).alias("form_n")))
    ends = roots(found.where("form IS NOT NULL"))
    rows = words.join(found, "word", "left").join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
