"""N-gram Jaccard self-join: which documents share nearly all their word shingles.

Sets of at most ``boundary`` shingles are *light*: every subset of a fixed size is a key, the size being the
overlap that two sets of these sizes need, so meeting under a key is a link. Larger sets are *heavy*: each
lists its rarest shingles (as many as it takes that two linked sets must share one of them), the lists are
scanned, and the pairs found are compared shingle by shingle. The boundary is the one with the least cost
over the sizes that the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import documents, record_batch, text_blocks
from waferline.llm.components import components
from waferline.llm.words import mix, text_sets
from waferline.session import cut_lineage

PERCENT = 80
SHINGLE_WORDS = 5
#: So many of the most frequent shingles are listed last; they are broadcast, at 8 bytes each.
MOST_COMMON = 1_000_000
#: A batch reports the shingles that it holds in so many documents.
OFTEN_IN_BATCH = 3
#: Bits of a shingle that tell most of the others from the common ones.
MARK_BITS = 22
#: Lists up to this length give all their pairs; of longer ones see ``_rest``.
LIST_PAIRS = 32
#: In a long list each set is paired with those so many places before it.
BACK = (1, 2, 3, 5, 8, 13)
#: Cost of an entry of a list against that of a subset key: its pairs are compared later.
SCAN_COST = 8
#: No set above this size is enumerated, whatever the costs say.
MOST_LIGHT = 24
#: Rounds of comparing pairs; the last one compares all that are left.
LINK_ROUNDS = 3
#: 64-bit words of a set's parity bitmap; it tells unlike sets of up to some 2,000 shingles apart.
PARITY_WORDS = 16
#: Bitmaps made together.
PARITY_ROWS = 256
#: Sets of a long list that meet in one go, and pairs that are looked at together.
CHUNK = 4096
PAIRS_AT_ONCE = 1 << 18
#: Lists whose pairs a task carries along to count them together, up to ``PAIRS_AT_ONCE`` pairs.
CARRIED = 64
#: Bits for each id in a filter of ids, and a filter's size at most (2**26 bits are 8 MB); beyond that more ids share a bit.
BITS_OF_ID = 16
FILTER_BITS = 26
#: Shingles of sets that a task keeps while it compares pairs.
KEPT_SHINGLES = 4_000_000


def overlap_needed(n, m, percent: int = PERCENT):
    """Shared shingles that sets of ``n`` and ``m`` need: 100 * shared >= percent * (n + m - shared)."""
    return -(-percent * (n + m) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_keys(n: int, percent: int = PERCENT, top: int | None = None) -> int:
    """Number of keys of a light set of ``n``, with partners up to size ``top``."""
    return sum(comb(n, overlap_needed(n, m, percent)) for m in partner_sizes(n, percent) if overlap_needed(n, m, percent) <= n and (top is None or m <= top))


def prefix_size(n, percent: int = PERCENT):
    """So many shingles of a set that it shares one of them with any partner."""
    return n - -(-percent * n // 100) + 1


def choose_boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The largest light size, at the least cost of subset keys and list entries together."""
    def cost(boundary: int) -> int:
        light = sum(c * subset_keys(n, percent, boundary) for n, c in sizes.items() if n <= boundary)
        heavy = sum(c * prefix_size(n, percent) for n, c in sizes.items() if 100 * n >= percent * (boundary + 1))
        return light + SCAN_COST * heavy

    return min(range(MOST_LIGHT + 1), key=cost)


def set_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit id per set, the same for equal sets."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values + np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


_KEY = "token bigint, set_id bigint, n int, pos int"
_MEMBERS = "doc_id bigint, set_id bigint, n bigint, parity array<bigint>, text_id bigint"
_MEMBER = [("doc_id", pa.int64()), ("set_id", pa.int64()), ("n", pa.int64()), ("parity", pa.list_(pa.int64())), ("text_id", pa.int64())]
_PAIR = "token bigint, a bigint, b bigint, n int, pos int"


def _schema(names: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in names.split(", "))])


def look_over(docs: DataFrame, words: int) -> DataFrame:
    """One reading of all texts, as a table: the members (kind null), and counts for ``survey`` (kind, value, times).

    Members have besides the shingles of sets that may be light (``small``); it is empty for larger sets.
    Kind 0 are the shingles that stand in ``OFTEN_IN_BATCH`` documents of a batch or more, kind 1 the sizes of sets
    up to 2 * MOST_LIGHT; larger ones count as one size.
    """
    kinds = [pa.int32(), pa.int64(), pa.int64()]
    schema = pa.schema([*_MEMBER, ("small", pa.list_(pa.int64())), *zip(("kind", "value", "times"), kinds)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, sizes = [], []
            for columns, values, n in _members_of(batch, words):
                few = n <= MOST_LIGHT
                ends = np.concatenate([[0], np.cumsum(np.where(few, n, 0))])
                small = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[np.repeat(few, n)].view(np.int64)))
                yield record_batch(schema, [*columns, small, *(pa.nulls(len(n), k) for k in kinds)])
                sets.append(values)
                sizes.append(n)
            if not sets:
                continue
            often, counts = _repeated(np.concatenate(sets))
            size, times = np.unique(np.minimum(np.concatenate(sizes), 2 * MOST_LIGHT), return_counts=True)
            kind = np.repeat(np.array([0, 1], np.int32), [len(often), len(size)])
            none = [pa.nulls(len(kind), f.type) for f in list(schema)[:-3]]
            yield record_batch(schema, [*none, kind, np.concatenate([often.view(np.int64), size]), np.concatenate([counts, times])])

    return _hashed(docs).mapInArrow(look, f"{_MEMBERS}, small array<bigint>, kind int, value bigint, times bigint")


def _repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that stand ``OFTEN_IN_BATCH`` times or more, and how often."""
    values = np.sort(values)
    # the start of each run that is long enough
    same = values[OFTEN_IN_BATCH - 1 :] == values[: max(0, len(values) - OFTEN_IN_BATCH + 1)]
    often = np.unique(values[np.flatnonzero(same)])
    return often, np.searchsorted(values, often, "right") - np.searchsorted(values, often, "left")


def survey(looked: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Common shingles (at most ``MOST_COMMON``), and how many documents have each set size up to 2 * MOST_LIGHT.

    Every document is counted. A shingle that is spread thinly over the batches can go unreported or count for
    less. Only the order in which shingles are listed depends on this, and any order gives the same links.
    """
    found = cut_lineage(looked.where("kind IS NOT NULL").groupBy("kind", "value").agg(F.sum("times").alias("n")))
    sizes = {r["value"]: r["n"] for r in found.where("kind = 1").collect()}
    # shorter lists give all their pairs; above that, the least count that at most MOST_COMMON shingles reach
    counts = found.where(f"kind = 0 AND n > {LIST_PAIRS}").groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count("*").alias("many"))
    least, total = (1 << 16) + 1, 0
    for row in sorted(counts.collect(), key=lambda r: -r["n"]):
        total += row["many"]
        if total > MOST_COMMON:
            break
        least = row["n"]
    common = found.where(f"kind = 0 AND n >= {least}").select("value").toPandas()["value"].to_numpy(np.int64)
    return np.sort(common.view(np.uint64)), sizes


def entries(docs: DataFrame, common: np.ndarray, boundary: int, words: int, percent: int) -> DataFrame:
    """List entries of heavy sets."""
    schema, shared = _schema(_KEY), docs.sparkSession.sparkContext.broadcast(common)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        marks = np.zeros(1 << MARK_BITS, bool)
        marks[(common >> np.uint64(64 - MARK_BITS)).astype(np.int64)] = True
        for batch in batches:
            met: set[int] = set()
            for _, _, data, bounds in text_blocks(batch.column(0)):
                values, cuts = text_sets(data, bounds, words)
                ids, n = set_ids(values, cuts), np.diff(cuts)
                _, first = np.unique(ids, return_index=True)
                fresh = np.zeros(len(ids), bool)
                fresh[first] = True
                fresh &= np.array([i not in met for i in ids.tolist()], bool)
                met.update(ids[fresh].tolist())
                yield record_batch(schema, _listed(values, cuts, ids, n, fresh, common, marks, boundary, percent))

    return documents(docs).select("text").mapInArrow(make, _KEY)


def light_keys(looked: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Subset keys of light sets (pos is the partner's size), from the shingles that their members have."""
    schema = _schema(_KEY)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy())])
            values, ids = batch.column(1).flatten().to_numpy().view(np.uint64), batch.column(0).to_numpy()
            for low in range(0, len(ids), 256):
                yield record_batch(schema, _subsets(values, cuts, ids, range(low, min(low + 256, len(ids))), boundary, percent))

    light = looked.where(f"n BETWEEN 1 AND {boundary}").select("set_id", "small").dropDuplicates(["set_id"])
    return light.mapInArrow(make, _KEY)


def _listed(values, cuts, ids, n, fresh, common, marks, boundary, percent) -> list:
    heavy = fresh & (100 * n >= percent * (boundary + 1)) & (n > 0)
    row = np.repeat(np.arange(len(n)), n)
    often = marks[(values >> np.uint64(64 - MARK_BITS)).astype(np.int64)]
    maybe = np.flatnonzero(often)
    if len(maybe):
        place = np.minimum(np.searchsorted(common, values[maybe]), len(common) - 1)
        often[maybe] = common[place] == values[maybe]
    rare = ~often
    rares = np.concatenate([[0], np.cumsum(rare)])
    before = rares[:-1] - rares[cuts[row]]
    pos = np.where(rare, before, rares[cuts[row + 1]] - rares[cuts[row]] + np.arange(len(values)) - cuts[row] - before)
    keep = heavy[row] & (pos < prefix_size(n, percent)[row])
    row = row[keep]
    return [values[keep].view(np.int64), ids[row], n[row].astype(np.int32), pos[keep].astype(np.int32)]


def _subsets(values, cuts, ids, light, boundary, percent) -> list:
    token, set_id, size, other = [], [], [], []
    for i in light:
        own = mix(values[cuts[i] : cuts[i + 1]])
        n = len(own)
        for m in partner_sizes(n, percent):
            need = int(overlap_needed(n, m, percent))
            if m > boundary or need > n:
                continue
            chosen = np.array(list(combinations(range(n), need)))
            sums = own[chosen].sum(axis=1, dtype=np.uint64) + np.uint64(min(n, m) * 1009 + max(n, m))
            token.append(mix(sums).view(np.int64))
            set_id.append(np.full(len(sums), ids[i]))
            size.append(np.full(len(sums), n, np.int32))
            other.append(np.full(len(sums), m, np.int32))
    token, set_id, size, other = (np.concatenate(x) for x in (token, set_id, size, other))
    return [token, set_id, size, other]


def _light_links(keys: DataFrame) -> DataFrame:
    """Links of the light sets: under a key for sizes n and m all sets of size n are linked with all of size m."""
    keys = keys.select("token", "set_id", "n", "pos").distinct()
    hubs = keys.groupBy("token").agg(F.min("set_id").alias("a"), F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("many"), F.min(F.col("n") == F.col("pos")).alias("same"))
    hubs = hubs.where("many > 1 AND (same OR low < high)")
    return keys.join(hubs.select("token", "a"), "token").select("a", F.col("set_id").alias("b")).where("a <> b").distinct()


def _possible(n, p, m, q, boundary: int, percent: int):
    """Whether sets of n and m shingles can still be linked when a shared one is at places p and q of their orders."""
    low, high = np.minimum(n, m), np.maximum(n, m)
    left = 1 + np.minimum(np.minimum(p, q) + np.minimum(n - p, m - q) - 1, low - 1)
    return (100 * low >= percent * high) & (high > boundary) & (left >= overlap_needed(n, m, percent))


def scan_lists(listed: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Pairs of sets that meet in a list (token null; n and pos are their sizes), and the entries of long lists, as they are (b null).

    A task gets whole lists, sorted by size, and holds at most ``LIST_PAIRS`` entries of the one it is in:
    of a longer list it pairs each set with a few before it, and passes the entries on.
    """
    schema = _schema(_PAIR)

    def pairs(a, b, n, m):
        turn = a > b
        return record_batch(schema, [pa.nulls(len(a), pa.int64()), np.minimum(a, b), np.maximum(a, b), np.where(turn, m, n).astype(np.int32), np.where(turn, n, m).astype(np.int32)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 4
        within = False  # the entries kept are the last few of a long list
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            yield from scan_rows([np.concatenate(x) for x in zip(kept, new)], len(kept[0]) if within else 0, False)
            kept, within = state[0], state[1]
        yield from scan_rows(kept, len(kept[0]) if within else 0, True)

    state: list = [None, False]

    def scan_rows(rows, seen: int, last: bool):
        token, set_id, n, pos = rows
        if not len(token):
            state[:] = [rows, False]
            return
        # repeated entries of equal sets fall together
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (set_id[1:] != set_id[:-1])
        seen = int(keep[:seen].sum())
        token, set_id, n, pos = (x[keep] for x in (token, set_id, n, pos))
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        ends = np.append(starts[1:], len(token))
        size = ends - starts
        whole = np.ones(len(starts), bool)
        whole[-1] = last
        long_ = size > LIST_PAIRS
        long_[0] |= seen > 0
        for g in np.unique(size[whole & ~long_ & (size > 1)]).tolist():
            first = starts[whole & ~long_ & (size == g)]
            left, right = np.triu_indices(g, 1)
            step = max(1, 400_000 // len(left))
            for low in range(0, len(first), step):
                i = (first[low : low + step, None] + left).ravel()
                j = (first[low : low + step, None] + right).ravel()
                ok = _possible(n[i], pos[i], n[j], pos[j], boundary, percent)
                if ok.any():
                    i, j = i[ok], j[ok]
                    yield pairs(set_id[i], set_id[j], n[i], n[j])
        for k in np.flatnonzero(long_).tolist():
            a, b = int(starts[k]), int(ends[k])
            new = a + (seen if k == 0 else 0)
            if new < b:
                yield record_batch(schema, [token[new:b], set_id[new:b], pa.nulls(b - new, pa.int64()), n[new:b].astype(np.int32), pos[new:b].astype(np.int32)])
            for back in BACK:
                j = np.arange(max(new, a + back), b)
                i = j - back
                ok = _possible(n[i], pos[i], n[j], pos[j], boundary, percent)
                if ok.any():
                    i, j = i[ok], j[ok]
                    yield pairs(set_id[i], set_id[j], n[i], n[j])
        low = len(token) if last else int(starts[-1])
        within = bool(not last and long_[-1])
        if within:
            low = max(low, len(token) - max(BACK))
        state[:] = [[x[low:] for x in (token, set_id, n, pos)], within]

    tasks = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = listed.select("token", "set_id", "n", "pos").repartition(tasks, "token").sortWithinPartitions("token", "n", "set_id")
    return dealt.mapInArrow(scan, _PAIR)


def _likely(found: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared): the pairs that share enough listed shingles, of those found in the lists.

    A set lists all but its last ``least - 1`` shingles, ``least`` being what any partner must share with it.
    Beyond the shingles that both list, a pair shares at most as many as the set whose list ends first does
    not list. Lists that are too long to give all pairs count as shared, as far as both sets stand in any.
    """
    pairs = found.where("token IS NULL").groupBy("a", "b", "n", F.col("pos").alias("m")).agg(F.count("*").alias("shared"))
    long_ = cut_lineage(found.where("token IS NOT NULL").groupBy("a").agg(F.countDistinct("token").alias("many")))
    left, right = (long_.select(F.col("a").alias(c), F.col("many").alias(f"long_{c}")) for c in ("a", "b"))
    pairs = pairs.join(left, "a", "left").join(right, "b", "left")
    more = F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / F.lit(100 + percent))
    rest = F.ceil(F.lit(percent) * F.greatest("n", "m") / F.lit(100)) - 1
    return pairs.where(F.col("shared") + more + rest >= need).select("a", "b", "shared")


def parities(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each set as a bitmap in which every shingle flips one bit, a row of ``PARITY_WORDS`` words a set.

    The bitmaps of two sets differ in no more bits than the sets have shingles that only one of them has.
    """
    bits, many = 64 * PARITY_WORDS, len(bounds) - 1
    out = np.empty((many, PARITY_WORDS), np.int64)
    for low in range(0, many, PARITY_ROWS):
        high = min(many, low + PARITY_ROWS)
        places = (values[bounds[low] : bounds[high]] % np.uint64(bits)).astype(np.int64)
        places += np.repeat(np.arange(0, bits * (high - low), bits), np.diff(bounds[low : high + 1]))
        flips = np.bincount(places, minlength=bits * (high - low)).astype(np.uint8) & 1
        out[low:high] = np.packbits(flips.reshape(high - low, bits), axis=1, bitorder="little").view(np.int64)
    return out


def differing_bits(left: str, right: str, words: int) -> Column:
    """The number of bits in which two bitmap columns differ."""
    return F.expr(" + ".join(f"bit_count({left}[{i}] ^ {right}[{i}])" for i in range(words)))


def may_link(left: str, right: str, percent: int) -> Column:
    """Whether the sizes and parity bitmaps of two aliased rows (n, parity) allow a link; true for all links."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    need = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return sizes & (differing_bits(f"{left}.parity", f"{right}.parity", PARITY_WORDS) <= n + m - 2 * need)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap in which every id of the column ``set_id`` has its bit, by its first bits; others may share one."""
    bits = min(max((BITS_OF_ID * ids.count()).bit_length(), 6), FILTER_BITS)
    places = ids.select(F.shiftrightunsigned("set_id", 64 - bits).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(place & 63)))").alias("held")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[words["word"].to_numpy()] = words["held"].to_numpy().view(np.uint64)
    return out


def may_hold(filter_: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each id has its bit in the bitmap: true for all ids that it was made of, and for few others."""
    bits = len(filter_).bit_length() + 5
    place = ids.view(np.uint64) >> np.uint64(64 - bits)
    return (filter_[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def packed_texts(docs: DataFrame, wanted: DataFrame, words: int, rows: DataFrame | None = None) -> DataFrame:
    """(set_id, packed) of one text of each wanted set; of the members ``rows``, if given, only texts of wanted sets are cut up again."""
    texts = None
    if rows is not None:
        picked = rows.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("text_id").alias("text_id"))
        texts = id_filter(cut_lineage(picked.select(F.col("text_id").alias("set_id"))))
    packed = squeezed(docs, id_filter(wanted), words, texts)
    return packed.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("packed").alias("packed"))


def squeezed(docs: DataFrame, held: np.ndarray, words: int, texts: np.ndarray | None = None) -> DataFrame:
    """(set_id, packed) of the sets that the bitmap may hold, which leaves most of the others out of an exchange.

    A second bitmap, of the hashes of texts, leaves other texts out before their sets are made.
    """
    schema, shared = _schema("set_id bigint, packed binary"), docs.sparkSession.sparkContext.broadcast((held, texts))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        held, texts = shared.value
        for batch in batches:
            if texts is not None:
                batch = batch.filter(pa.array(may_hold(texts, batch.column(1).to_numpy())))
            if not batch.num_rows:
                continue
            for _, _, data, bounds in text_blocks(batch.column(0)):
                ids = set_ids(*text_sets(data, bounds, words))
                _, first = np.unique(ids, return_index=True)
                first = first[may_hold(held, ids[first])]
                yield record_batch(schema, [ids[first], [packer.compress(data[bounds[i] : bounds[i + 1]].tobytes()) for i in first.tolist()]])

    return _hashed(docs).select("text", "text_id").mapInArrow(squeeze, "set_id bigint, packed binary")


def compare(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked, by their whole shingle sets, from the texts (set_id, packed)."""
    schema = _schema("a bigint, b bigint")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker, known, held = zstandard.ZstdDecompressor(), {}, 0

        def shingles(column: pa.Array, id_: int, i: int) -> np.ndarray:
            nonlocal held
            if id_ not in known:
                data = np.frombuffer(unpacker.decompress(column[i].as_py()), np.uint8)
                if held > KEPT_SHINGLES:
                    known.clear()
                    held = 0
                known[id_] = text_sets(data, np.array([0, len(data)]), words)[0]
                held += len(known[id_])
            return known[id_]

        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                left, right = shingles(batch.column(2), a, i), shingles(batch.column(3), b, i)
                place = np.searchsorted(left, right)
                place[place == len(left)] = 0
                same = int((left[place] == right).sum())
                keep.append(100 * same >= percent * (len(left) + len(right) - same))
            keep = pa.array(keep, pa.bool_())
            yield record_batch(schema, [batch.column(0).filter(keep), batch.column(1).filter(keep)])

    def of(name: str, side: str) -> DataFrame:
        # before the join, so that the texts which no pair needs are not exchanged with it
        met = pairs.select(F.col(name).alias("set_id")).distinct()
        return texts.join(met, "set_id", "left_semi").select(F.col("set_id").alias(name), F.col("packed").alias(side))

    both = pairs.join(of("b", "right"), "b").join(of("a", "left"), "a")
    return both.select("a", "b", "left", "right").mapInArrow(check, "a bigint, b bigint")


def apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sets are not in one component."""
    left, right = (classes.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b"))
    both = pairs.join(left, "a", "left").join(right, "b", "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns)


def link_up(docs: DataFrame, rows: DataFrame, pairs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The components of sets with the links among ``pairs`` (a, b, shared) added; ``rows`` are the members of ``docs``.

    Pairs within a component need no look. In each of the first rounds every set meets the one it shares
    most with among those of other components; in the last round all pairs that are still apart are compared.
    """
    texts = None
    for number in range(LINK_ROUNDS):
        pairs = cut_lineage(apart(pairs, classes))
        if pairs.isEmpty():
            break
        if texts is None:
            wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct())
            texts = cut_lineage(packed_texts(docs, wanted, words, rows))
        chosen = pairs
        if number < LINK_ROUNDS - 1:
            chosen = cut_lineage(pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b"))
        links = compare(texts, chosen.select("a", "b"), words, percent)
        if number < LINK_ROUNDS - 1:
            pairs = pairs.join(chosen, ["a", "b"], "left_anti")
        classes = cut_lineage(components(links.unionByName(classes.select(F.col("root").alias("a"), F.col("node").alias("b")))))
    return classes


def _rest(entries_: DataFrame, classes: DataFrame, parity: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(a, b, shared): pairs of long lists whose sets are not yet in one component and share enough.

    In each list the sets outside of its largest component meet all those of other components. A pair whose
    parity bitmaps differ in more bits than two linked sets have shingles apart does not come out. The others
    are counted, once for each list that both sets stand in.
    What a pair shares in short lists need not be added: one that stands in any of those has been compared
    or ruled out before.
    """
    roots = classes.select(F.col("node").alias("set_id"), "root")
    rows = entries_.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    rows = cut_lineage(rows)
    groups = rows.groupBy("token", "root").agg(F.count("*").alias("many"))
    main = groups.groupBy("token").agg(F.max_by("root", F.struct("many", "root")).alias("main"), F.count("*").alias("groups"), F.sum("many").alias("many"))
    chunks = F.ceil(F.col("many") / F.lit(CHUNK)).cast("int").alias("chunks")
    mixed = rows.join(main.where("groups > 1").select("token", "main", chunks), "token").join(parity, "set_id")
    met = _meetings(cut_lineage(mixed), boundary, percent)
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / F.lit(100 + percent))
    rest = F.ceil(F.lit(percent) * F.greatest("n", "m") / F.lit(100)) - 1
    met = met.groupBy("a", "b", (need - rest).alias("least")).agg(F.sum("shared").alias("shared"))
    return met.where("shared >= least").select("a", "b", "shared")


def _meetings(mixed: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(a, b, n, m, shared): pairs that may be linked, the sets' sizes, and in how many of a few lists they met.

    Lists are cut into ``chunks``; each chunk's sets outside of the list's largest component meet each chunk's
    sets, and a task holds two chunks at a time.
    """
    names = "a bigint, b bigint, n int, m int, shared bigint"
    schema = _schema(names)

    def meet(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        left, right = ([c[order] for c in side] for side, order in ((s, np.argsort(s[1], kind="stable")) for s in (left, right)))
        (a, n, p, root, main, bits), (b, m, q, other, _, more) = left, right
        low = 0
        while low < len(a):
            # partners are at least so large, and at most as for the largest of the step
            first = int(np.searchsorted(m, -(-percent * n[low] // 100)))
            step = max(1, PAIRS_AT_ONCE // max(1, len(b) - first))
            high = min(len(a), low + step)
            last = int(np.searchsorted(m, 100 * n[high - 1] // percent, "right"))
            i, j = slice(low, high), slice(first, last)
            may = _possible(n[i, None], p[i, None], m[None, j], q[None, j], boundary, percent) & (root[i, None] != other[None, j])
            may &= (other[None, j] == main[0]) | (a[i, None] < b[None, j])  # once
            x, y = np.nonzero(may)
            for at in range(0, len(x), PAIRS_AT_ONCE // 16):
                u, v = x[at : at + PAIRS_AT_ONCE // 16] + low, y[at : at + PAIRS_AT_ONCE // 16] + first
                apart_ = np.bitwise_count(bits[u] ^ more[v]).sum(axis=1, dtype=np.int64)
                ok = apart_ <= n[u] + m[v] - 2 * overlap_needed(n[u], m[v], percent)
                if ok.any():
                    u, v = u[ok], v[ok]
                    turn = a[u] > b[v]
                    yield [np.minimum(a[u], b[v]), np.maximum(a[u], b[v]), np.where(turn, m[v], n[u]).astype(np.int32), np.where(turn, n[u], m[v]).astype(np.int32)]
            low = high

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found, lists = None, {0: [], 1: []}, [], 0

        def pairs(last: bool = False) -> Iterator[pa.RecordBatch]:
            nonlocal lists
            if held[0] and held[1]:
                lists += 1
                for some in meet(*([np.concatenate(c) for c in zip(*held[side])] for side in (0, 1))):
                    found.append(some)
                    if sum(len(f[0]) for f in found) >= PAIRS_AT_ONCE:
                        yield counted(found)
            if found and (last or lists >= CARRIED):
                yield counted(found)
                lists = 0

        def counted(found: list[list[np.ndarray]]) -> pa.RecordBatch:
            a, b, n, m = (np.concatenate(c) for c in zip(*found))
            found.clear()
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            return record_batch(schema, [a[first], b[first], n[order][first], m[order][first], np.diff(np.append(first, len(a)))])

        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in range(4)]  # token, one, two, side
            cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in keys], axis=0)) + 1
            columns = [np.array(batch.column(c)).astype(np.int64) for c in range(4, 9)]
            # unsigned: of negative numbers numpy counts the bits of the absolute value
            columns.append(batch.column(9).flatten().to_numpy().view(np.uint64).reshape(-1, PARITY_WORDS))
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if low == high:
                    continue
                now = tuple(int(c[low]) for c in keys[:3])
                if now != key:
                    yield from pairs()
                    key, held = now, {0: [], 1: []}
                held[int(keys[3][low])].append([c[low:high] for c in columns])
        yield from pairs(True)

    own = F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    columns = ["set_id", "n", "pos", "root", "main", "parity"]
    left = mixed.where("root <> main").select("token", own.alias("one"), each.alias("two"), F.lit(0).alias("side"), *columns)
    right = mixed.select("token", each.alias("one"), own.alias("two"), F.lit(1).alias("side"), *columns)
    tasks = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.unionByName(right).repartition(tasks, "token", "one", "two").sortWithinPartitions("token", "one", "two", "side")
    return dealt.mapInArrow(walk, names)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id of every row.

    Sets are the distinct shingles of ``words`` words, A-Z as a-z; a shorter text is one shingle, and one
    without words (or null) has an empty set, which is linked with nothing and is its own component.
    Sets are linked when shared shingles are at least ``percent`` in a hundred of all of both.
    ``component_id`` is the smallest doc_id that links reach. Equal sets are handled as one, so copies and
    repeated rows cost one set. A null doc_id stays null and lends no id to its component; a component of
    such rows only has a null id. Shingles and sets are told apart by 64-bit hashes.
    """
    looked = cut_lineage(look_over(docs, words))
    common, sizes = survey(looked)
    boundary = choose_boundary(sizes, percent)
    rows = looked.where("kind IS NULL").drop("small", "kind", "value", "times")
    listed = entries(docs, common, boundary, words, percent)
    links = []
    if boundary:
        links.append(_light_links(light_keys(looked, boundary, percent)))
    found = cut_lineage(scan_lists(listed, boundary, percent))
    pairs = cut_lineage(_likely(found, percent))
    links = links[0] if links else pairs.select("a", "b").limit(0)
    long_ = cut_lineage(found.where("token IS NOT NULL").select("token", F.col("a").alias("set_id"), "n", "pos"))
    classes = link_up(docs, rows, pairs, cut_lineage(components(links)), words, percent)
    if not long_.isEmpty():
        more = cut_lineage(_rest(long_, classes, parity_of(rows), boundary, percent))
        classes = link_up(docs, rows, more, classes, words, percent)
    return labelled(rows, classes)


def labelled(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id of the members, by the components of their sets."""
    rows = rows.select("doc_id", "set_id", "n")
    rooted = rows.join(classes.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = rooted.join(least, "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "set_id")


def parity_of(rows: DataFrame) -> DataFrame:
    """(set_id, parity) of the sets of the members."""
    return rows.where("n > 0").select("set_id", "parity").dropDuplicates(["set_id"])


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, text and text_id, a 64-bit hash of the text."""
    return documents(docs).withColumn("text_id", F.xxhash64("text"))


def _members_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """The members of a batch of doc_id, text and text_id, some texts at a time; their shingles and sizes."""
    for low, high, data, bounds in text_blocks(batch.column(1)):
        values, cuts = text_sets(data, bounds, words)
        n, bits = np.diff(cuts), parities(values, cuts)
        parity = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * PARITY_WORDS, pa.int32()), pa.array(bits.ravel()))
        yield [batch.column(0).slice(low, high - low), set_ids(values, cuts), n, parity, batch.column(2).slice(low, high - low)], values, n


def members(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, set_id, n, parity, text_id) of every row."""
    schema = pa.schema(_MEMBER)

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns, _, _ in _members_of(batch, words):
                yield record_batch(schema, columns)

    return _hashed(docs).mapInArrow(size, _MEMBERS)
