"""The operators against brute force, on small tables with nulls, empty texts, ties, copies and clashing columns."""

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waferline.llm import jaccard, mixing, packing, quality, queries, simhash, suffix, token_files, topk, toxicity, urls

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, row string"


def corpus(n=160, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(6, 120))) for _ in range(12)]
    texts = [None, "", " \n ", "one", "one two", "One two", "word " * 400, "é" * 150 + "x" + "é" * 150]
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.3:
            texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 90))))
        elif kind < 0.6:
            near = rng.choice(base).split()
            near[rng.randrange(len(near))] = "changed" + str(rng.randint(0, 3))
            texts.append(" ".join(near))
        elif kind < 0.8:
            texts.append(rng.choice(base))
        else:
            texts.append(f"{rng.choice(vocabulary)} {passage} {rng.choice(vocabulary)}")
    rows = [(i * 3, t, "en", f"s{i % 5}" if i % 7 else None, len(t or ""), "clash", "clash", "clash") for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, and repeated rows."""
    rows = corpus(30)
    return spark.createDataFrame([*rows, *rows[5:15], *[(None, *r[1:]) for r in rows[8:12]], (9, "another text under an id that is there", *rows[0][2:])], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))) if found else frozenset()


def brute_components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * same >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("limits", [{}, {"LIST_PAIRS": 3}, {"LIST_PAIRS": 2, "SCAN_COST": 0}, {"SCAN_COST": 1000, "MOST_COMMON": 0}, {"LIST_PAIRS": 2, "MOST_COMMON": 0, "CARRIED": 2}])
def test_jaccard(docs, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute_components(corpus())


def test_jaccard_odd_rows(odd, none):
    found = jaccard.near_duplicates(odd).collect()
    assert len(found) == odd.count() and jaccard.near_duplicates(none).collect() == []
    assert all(r["component_id"] == r["doc_id"] for r in found if r["n_shingles"] == 0)


@pytest.mark.parametrize("bits", [26, 8])
def test_texts_that_no_pair_needs_are_not_exchanged(docs, monkeypatch, bits):
    monkeypatch.setattr(jaccard, "FILTER_BITS", bits)
    sets = jaccard.members(docs, 5).select("set_id").distinct()
    wanted = sets.orderBy("set_id").limit(3)
    ids = {r[0] for r in wanted.collect()}
    held = jaccard.id_filter(wanted)
    known = np.array([r[0] for r in sets.collect()], np.int64)
    assert ids <= set(known[jaccard.may_hold(held, known)].tolist()) and jaccard.may_hold(held, known).sum() < len(known) / 4
    assert {r["set_id"] for r in jaccard.squeezed(docs, held, 5).collect()} == set(known[jaccard.may_hold(held, known)].tolist())
    assert {r["set_id"] for r in jaccard.packed_texts(docs, wanted, 5).collect()} == ids


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted((r[0], r[1]) for r in rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        marks = np.frombuffer(bytes(gone), np.uint8).astype(int)
        out[doc] = (len(data), int(marks.sum()), int((np.diff(np.append(0, marks)) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("limits", [{}, {"MARK_ROWS": 1, "RUN": 7, "_BLOCK": 500, "SHARD_BYTES": 2000}, {"_SEGMENT": 128}])
def test_suffix_dedup(docs, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(suffix, name, value)
    rows = [(r[0], r[1] or "") for r in corpus()]
    got = {r["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in suffix.remove_repeats(docs).collect()}
    assert got == brute_repeats(rows)


def test_marking_runs_takes_little_memory(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 123, 2000, np.uint8).tobytes().decode() for _ in range(1500)]
    ids = [None, *range(len(texts) - 1, 0, -1)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([0] * len(texts), pa.int32()), pa.array(texts)], names=["doc_id", "copy", "text"])
    tracemalloc.start()
    found = pa.Table.from_batches(list(suffix._runs_of(batch, 100, 24)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20, peak
    monkeypatch.setattr(suffix, "_BLOCK", 1)
    order = [("doc_id", "ascending"), ("start", "ascending")]
    assert pa.Table.from_batches(list(suffix._runs_of(batch, 100, 24))).sort_by(order) == found.sort_by(order)


def test_suffix_dedup_odd_rows(odd, none):
    found = suffix.remove_repeats(odd).collect()
    assert len(found) == odd.count() and suffix.remove_repeats(none).collect() == []
    assert all(len(r["kept"]) == 0 for r in found if r["number"] > 1 and r["n_bytes"] >= 100)
    assert all(len(r["kept"]) == r["n_bytes"] for r in found if r["n_bytes"] < 100)


def test_flooded_marks_stay_whole(spark, monkeypatch):
    """Two runs with one side in common, one in the rows that flood a mark and one batches later."""
    monkeypatch.setattr(suffix, "MARK_ROWS", 25)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        near = [(1000 + i) << 32 | (5000 + i) for i in range(200)]
        near[96] = (1000 + 4) << 32 | 5096
        # mark 7 has 100 runs; of the 20 of mark 8 the last two share a side, and those of mark 9 nothing
        near[119] = near[118] & ~0xFFFFFFFF | 1
        rows = [(7 + (i >= 100) + (i >= 120), 1, i, i, 0, 0, 150, n) for i, n in enumerate(near[:140])]
        got = {r["content"] for r in suffix._sift(spark.createDataFrame(rows, suffix._RUN)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {*range(100), 118, 119}


def token_ids(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    return [(r[0], np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")) for r in rows]


def test_packing(docs, odd, none):
    want = dict(token_ids(corpus()))
    found = packing.pack(packing.token_pieces(docs, queries.vocabulary(), 64), 64, shard_pieces=40).collect()
    pieces, places = Counter(), {}
    for r in found:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 64 * r["piece"] and len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]] += r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces == Counter({d: len(x) for d, x in want.items()})
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= 1.05 * sum(map(len, want.values())) / 64 + 1
    assert packing.pack(packing.token_pieces(odd, queries.vocabulary())).count() >= odd.count()
    assert packing.pack(packing.token_pieces(none, queries.vocabulary())).collect() == []


def test_token_files(spark, docs, odd, none):
    files = token_files.write_files(docs, queries.vocabulary(), file_ids=2000, block=256)
    got = sorted(tuple(r) for r in token_files.read_files(files).collect())
    start, want = 0, []
    for doc, ids in sorted(token_ids(corpus()), key=lambda x: x[0]):
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want and files.count() > 4
    reader = token_files.TokenReader(files.orderBy("part", "number").first()["path"])
    whole = reader.slice(0, reader.ids)
    assert reader.bits == 16 and (reader.slice(100, 700) == whole[100:700]).all()
    assert token_files.read_files(token_files.write_files(odd, queries.vocabulary())).count() == odd.count()
    assert token_files.read_files(token_files.write_files(none, queries.vocabulary())).collect() == []


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (token_files.unpack(data, bits, 1001) == ids).all()
    assert token_files.bits_for(2**bits) == bits


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(300)]
    vectors += [(300 + i, vectors[0][1]) for i in range(90)]
    bad = [(900, None), (901, [1.0, None, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (950, []), (951, [1.0])]
    table = spark.createDataFrame([(i, x, "clash") for i, x in vectors + bad], "vec_id bigint, embedding array<double>, score string")
    rows = topk.cut_lineage(topk.quantised(table))
    got = [tuple(r) for r in topk.top_k(rows, rows.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    whole = vectors + bad[4:]
    x = {i: np.floor(256 * np.array([*v, *[0.0] * (6 - len(v))])).astype(int) for i, v in whole}
    want = []
    for q in sorted(i for i in x if i % 50 == 0):
        best = sorted((-int(x[q] @ x[c]), c) for c in x if c != q)[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert got == want
    assert topk.top_k(rows.limit(0), rows.limit(0)).collect() == []
    few = topk.cut_lineage(rows.where("vec_id IN (0, 50, 51)"))
    assert topk.top_k(few, few.where("vec_id = 0")).count() == 2


def test_top_k_over_shards(spark, monkeypatch):
    """Queries pass by every shard of candidates as rows; no pair of blocks is a row of a join."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(topk, "SHARD_VALUES", 400)
    rng = np.random.default_rng(2)
    for scale in (1, 1 << 21):  # scores fit 32-bit floating point, or don't
        x = rng.integers(-3, 4, (500, 6)) * scale
        x[400:] = x[7]
        rows = topk.cut_lineage(spark.createDataFrame([(i, 1000 + i // 2, v.tolist()) for i, v in enumerate(x)], "row_id bigint, vec_id bigint, x array<bigint>"))
        found = topk.top_k(rows, rows.where("row_id % 25 = 0"), 7)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and plan.count("Repartition") == 1
        want = []
        for q in range(0, 500, 25):
            best = sorted((-int(x[q] @ x[c]), 1000 + c // 2) for c in range(500) if c != q)[:7]
            want += [(1000 + q // 2, i + 1, c, -s) for i, (s, c) in enumerate(best)]
        assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_top_k_bar_of_blocks_before():
    rng = np.random.default_rng(3)
    for kind in (np.float32, np.float64):
        x, q = rng.integers(-9, 10, (300, 5)).astype(kind), rng.integers(-9, 10, (4, 5)).astype(kind)
        score, lists = x @ q.T, np.sort(x, axis=0)
        none, known = np.full(4, -np.inf, kind), np.sort(score, axis=0)[-3].astype(kind)
        for bar, k in ((none, 3), (known, 3), (known + 1, 3)):
            query, candidate = topk.read_lists(x, lists, q, bar, k)
            left = set(zip(query.tolist(), candidate.tolist()))
            needed = np.maximum(bar, known) if bar is none else bar
            assert {(b, a) for a, b in zip(*np.nonzero(score >= needed))} <= left and len(left) < score.size / 2


def test_top_k_of_large_components(spark):
    vectors = [(0, [1.0, 0.0]), (1, [600_000.0, 0.0]), (2, [700_000.0, 0.0]), (3, [2.0**40, 1.0]), (4, [-(2.0**41), 0.0])]
    rows = topk.cut_lineage(topk.quantised(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")))
    got = [(r["vec_id"], r["score"]) for r in topk.top_k(rows, rows.where("vec_id = 0"), 4).orderBy("rank").collect()]
    assert got == [(3, 1 << 56), (2, 700_000 << 16), (1, 600_000 << 16), (4, -(1 << 57))]
    big = np.array([[1 << 40, 1]], np.int64)
    with pytest.raises(OverflowError):
        topk.exact_scores(big, big)
    with pytest.raises(Exception, match="64 bits"):
        topk.quantised(spark.createDataFrame([(0, [1e300])], "vec_id bigint, embedding array<double>")).collect()


def test_near_duplicates_of_long_lists(spark, monkeypatch):
    """Pairs of long lists are found in any chunk, by their parity bitmaps, and few of the pairs come out."""
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    rng = np.random.default_rng(5)
    common = [f"w{i}" for i in range(60)]
    texts, want = [], {}
    for i in range(60):  # pairs that are linked; all others share too little
        own = [f"x{i}y{k}" for k in rng.integers(0, 1 << 30, 240)]
        texts += [" ".join(common + own), " ".join(common + own[:-12])]
        want |= {2 * i: 2 * i, 2 * i + 1: 2 * i}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = jaccard.cut_lineage(jaccard.members(docs, 5))
    parity = jaccard.parity_of(rows)
    # every set stands in ten lists, in no component yet
    listed = rows.select("set_id", F.col("n").cast("int").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(69))).alias("pos")).withColumn("token", F.col("pos").cast("bigint"))
    none = rows.selectExpr("set_id AS node", "set_id AS root").limit(0)
    found = jaccard._rest(listed.select("token", "set_id", "n", "pos"), none, parity, 8, 80).collect()
    of = {r["set_id"]: r["doc_id"] for r in rows.collect()}
    pairs = {tuple(sorted((of[r["a"]], of[r["b"]]))): r["shared"] for r in found}
    assert len(pairs) == len(found) and pairs == {(2 * i, 2 * i + 1): 70 for i in range(60)}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == want


def test_parities_in_steps(monkeypatch):
    monkeypatch.setattr(jaccard, "PARITY_ROWS", 7)
    rng = np.random.default_rng(6)
    n = rng.integers(0, 90, 50)
    bounds = np.concatenate([[0], np.cumsum(n)])
    values = rng.integers(0, 1 << 64, bounds[-1], dtype=np.uint64)
    bits = np.zeros((50, 64 * jaccard.PARITY_WORDS), np.uint8)
    for i in range(50):
        for v in values[bounds[i] : bounds[i + 1]].tolist():
            bits[i, v % bits.shape[1]] ^= 1
    assert (np.packbits(bits, axis=1, bitorder="little").view(np.int64) == jaccard.parities(values, bounds)).all()


def test_near_duplicates_read_texts_few_times(docs, monkeypatch):
    """Light keys come from the members; only texts that pairs need are cut up again."""
    looked = jaccard.cut_lineage(jaccard.look_over(docs, 5))
    keys = jaccard.light_keys(looked, 8, 80)
    assert "text" not in keys._jdf.queryExecution().analyzed().toString().replace("text_id", "")
    rows = looked.where("kind IS NULL")
    wanted = rows.where("n > 0").select("set_id").distinct().limit(5)
    wanted = jaccard.cut_lineage(wanted)
    ids = {r["set_id"] for r in wanted.collect()}
    assert {r["set_id"] for r in jaccard.packed_texts(docs, wanted, 5, rows).collect()} == ids
    texts = {r["text_id"] for r in rows.join(wanted, "set_id", "left_semi").collect()}
    held = jaccard.id_filter(docs.sparkSession.createDataFrame([(t,) for t in texts], "set_id bigint"))
    every = np.full(1, (1 << 64) - 1, np.uint64)
    assert ids <= {r["set_id"] for r in jaccard.squeezed(docs, every, 5, held).collect()}
    assert jaccard.squeezed(docs, every, 5, held).count() < docs.count() / 4


def test_mixing(docs, odd, none):
    rows = mixing.mix_documents(docs).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_documents(docs.repartition(3)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    source = {r[0]: r[3] for r in corpus()}
    totals, targets, sizes = Counter(), {}, Counter()
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        totals[source[r["doc_id"]]] += r["taken"]
        sizes[source[r["doc_id"]]] += r["size"]
        targets[source[r["doc_id"]]] = r["target"]
    want = {}
    names = [*sorted(s for s in sizes if s is not None), None]
    weight, free, rest = {s: i % 3 + 1 for i, s in enumerate(names)}, set(names), sum(sizes.values())
    while free:
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        full = [s for s in free if share[s] > 3 * sizes[s]]
        want |= {s: 3.0 * sizes[s] for s in full} if full else share
        rest -= sum(want[s] for s in full)
        free = free - set(full) if full else set()
    assert targets == pytest.approx(want)
    for s in names:
        assert abs(totals[s] - targets[s]) <= 0.02 * targets[s] + 5
    assert mixing.mix_documents(odd).count() == odd.count() and mixing.mix_documents(none).collect() == []


def test_mixing_makes_up_for_long_documents(spark):
    rows = [(i, "w " * 100, "a") for i in range(1000)] + [(2000, "w " * 500_000, "a")]
    # a second source, of weight 2, brings the first one's target to 1.1 of its size
    rows += [(3000, "w " * 1_380_000, "b")]
    found = mixing.mix_documents(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).where("doc_id < 3000").collect()
    target = found[0]["target"]
    assert target == pytest.approx(660_000) and abs(sum(r["taken"] for r in found) - target) <= 0.001 * target


def test_targets_stop_at_three_times_the_size(spark):
    table = spark.createDataFrame([("sa", 1000, 5), ("sb", 10, 5), ("sc", 10, 5), ("sd", 0, 5)], "skey string, source_size bigint, n bigint")
    got = {r["skey"]: r["target"] for r in mixing.targets(table).collect()}
    assert got == pytest.approx({"sa": 960.0, "sb": 30.0, "sc": 30.0, "sd": 0.0})


def test_urls(spark):
    pages = [(1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.NET/en/a?x#y"), (4, "http://example.net#/en/"), (5, "a://b.org/fr/1"), (6, "a://org/FR/1"), (7, "a://xnet/"), (8, "a://x.net?/en/"), (9, "://example.com/de/"), (9, "://example.com/de/"), (10, "")]
    table = spark.createDataFrame([(i, u, "clash") for i, u in pages], "page_id bigint, url string, host string")
    got = sorted(urls.judge(table, queries.URL_RULES).collect())
    assert [tuple(r)[:4] for r in got] == sorted([(1, "", "", None), (2, "", "", None), (3, "www.example.net", "/en/a", "example.net/en/"), (4, "example.net", "", None), (5, "b.org", "/fr/1", "org/fr/"), (6, "org", "/FR/1", None), (7, "xnet", "/", None), (8, "x.net", "", None), (9, "example.com", "/de/", "example.com/de/"), (9, "example.com", "/de/", "example.com/de/"), (10, "", "", None)], key=lambda r: r[0])
    assert {r["page_id"]: r["verdict"] for r in got}[3] == "allow" and {r["verdict"] for r in got} <= {"allow", "block"}
    assert urls.judge(table.limit(0), queries.URL_RULES).collect() == []


def test_mined_rules_match_counts(spark):
    rng = random.Random(4)
    rows = [([f"a{rng.randint(0, 2)}", f"b{rng.randint(0, 2)}"], rng.choice(["block", "allow", "allow"])) for _ in range(200)]
    rows += [(["a0", "c"], "block")] * 30
    found = urls.mine_rules(spark.createDataFrame(rows, "items array<string>, verdict string"), 0.02, 0.7).collect()
    assert found
    for r in found:
        hold = [v for items, v in rows if set(r["items"]) <= set(items)]
        assert hold.count(r["verdict"]) / len(hold) == pytest.approx(r["confidence"]) and hold.count(r["verdict"]) >= 0.02 * len(rows)


def test_rules_of_deep_urls(spark):
    """Only the fourth path part tells the verdict of pages without a fixed rule; one URL has 20,001 parts."""
    rng = random.Random(9)
    pages = []
    for i in range(240):
        told = rng.choice(["ads", "wiki"])
        host = f"h{rng.randint(0, 3)}." + ("example.net" if told == "ads" else "org")
        pages.append((i, f"http://{host}/{'' if told == 'ads' else 'fr/'}a{rng.randint(0, 2)}/b/c{i}/{told}/{i}"))
    unknown = [(1000, "http://q.test/x/y/z/ads/1"), (1001, "http://q.test/x/y/z/wiki/1"), (1002, "http://q.test/" + "p/" * 20000 + "ads"),
               (1003, "http://q.test/adsx"), (1004, "http://ads.test/")]
    table = spark.createDataFrame(pages + unknown, "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(table, queries.URL_RULES).collect()}
    assert [got[i] for i in range(1000, 1005)] == ["block", "allow", "block", "allow", "allow"]
    assert all(got[i] == ("block" if "example.net" in u else "allow") for i, u in pages)


def test_rules_with_members_match_all_combinations(spark):
    """Tokens of the same rows are one item; the rules hold what mining every token would."""
    rng = random.Random(5)
    rows = []
    for _ in range(150):
        items = [x for x in "pqr" if rng.random() < 0.5] + (["s", "s2", "s3"] if rng.random() < 0.4 else [])
        rows.append((items, "block" if "p" in items and "s" in items else rng.choice(["allow", "block"])))
    found = urls.mine_rules(spark.createDataFrame(rows, "items array<string>, verdict string"), 0.05, 0.7).collect()
    every = [frozenset(c) for n in range(1, 7) for c in itertools.combinations(["p", "q", "r", "s", "s2", "s3"], n)]
    want = {}
    for c in every:
        hold = [v for items, v in rows if c <= set(items)]
        for v in ("allow", "block"):
            if hold and hold.count(v) >= 0.05 * len(rows) and hold.count(v) / len(hold) >= 0.7:
                want[c, v] = hold.count(v) / len(hold)
    want = {(c, v) for (c, v), x in want.items() if not any(d < c and w == v and y >= x for (d, w), y in want.items())}
    assert {(frozenset(c), r["verdict"]) for r in found for c in itertools.product(*r["members"])} == want


def test_fingerprints(spark, docs, odd, none):
    rows = sorted(corpus(), key=lambda r: r[0])
    got = {r["doc_id"]: r for r in simhash.compare_with_edits(docs).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for i, r in enumerate(rows):
        text, after = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        own = got[r[0]]
        assert own["n_chars"] == len(text) and own["edited_text"] == text[: len(text) - quarter] + after[:quarter]
        assert by_text.setdefault(text, own["fingerprint"]) == own["fingerprint"]
        apart = bin(int(own["fingerprint"], 16) ^ int(got[rows[(i + 1) % len(rows)][0]]["fingerprint"], 16)).count("1")
        assert own["near_next"] == pytest.approx(1 - apart / 128)
    assert simhash.compare_with_edits(odd).count() == odd.count() and simhash.compare_with_edits(none).collect() == []
    prints = sorted({r["fingerprint"] for r in got.values()})
    flipped = [f"{int(p, 16) ^ (1 << 5) ^ (1 << 100):032x}" for p in prints[:20]]
    every = sorted({*prints, *flipped})
    want = {(a, b, bin(int(a, 16) ^ int(b, 16)).count("1")) for a in every for b in every if a < b and bin(int(a, 16) ^ int(b, 16)).count("1") <= 3}
    found = simhash.within_radius(spark.createDataFrame([(p,) for p in every + every[:5]] + [(None,)], "fingerprint string")).collect()
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def labelled(spark, column):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(["the", "tree", "river", "stone", "walks", "under"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(5, 80))]
        y = int(rng.random() < 0.3)
        if column == "toxic" and y:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "grobbel" + rng.choice("abc")])
        if column == "quality" and not y:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), "en", "s", 1, "clash", "clash", "clash"))
        labels.append((i, y, y))
    rows += [(400, None, "en", "s", 1, "", "", ""), (401, "", "en", "s", 1, "", "", ""), (401, "", "en", "s", 1, "", "", "")]
    labels += [(None, 1, 1), (3, None, None), (5000, 1, 1), (402, 7, 7)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {i: y for i, y, _ in labels[:400]}


@pytest.mark.parametrize("module, column, modulus, held", [(toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)])
def test_classifiers(spark, none, module, column, modulus, held):
    docs, labels, truth = labelled(spark, column)
    got = module.classify(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held) for r in got)
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.97
    assert len({r["score"] for r in got if r["doc_id"] >= 400}) == 1
    # labels of held-out rows change nothing
    turned = labels.withColumn(column, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held, 1 - F.col(column)).otherwise(F.col(column)))
    assert sorted((r["doc_id"], r["score"]) for r in module.classify(docs, turned).collect()) == sorted((r["doc_id"], r["score"]) for r in got)
    assert module.classify(none, labels).collect() == [] and module.classify(docs, labels.limit(0)).count() == 403


def test_shouting_is_judged_on_the_whole_text():
    texts = ["x" * 2000 + "X" * 4000, "X" * 2000 + "x" * 18_000, "X" * 50]
    assert toxicity._votes(np.ones((3, 1), np.float32), texts)[:, 4].tolist() == [1, 0, 1]


def test_label_model_finds_the_good_voters():
    rng = np.random.default_rng(0)
    y = rng.random(3000) < 0.3
    votes = np.zeros((3000, 6), np.float32)
    for j, right in enumerate((0.95, 0.9, 0.85, 0.8)):
        truth = np.where(y, 1, -1)
        votes[:, j] = np.where(rng.random(3000) < right, truth, -truth)
    votes[:, 4] = votes[:, 3]
    votes[:, 5] = rng.choice([-1, 1], 3000)
    model = toxicity.fit_label_model(votes, 0.3)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
    assert model.rates[1, 0, 1] == pytest.approx(0.95, abs=0.04)
    assert model.weights[3] < 0.7 and model.correlations[3, 4] > 0.9


def test_pipeline_stages(spark, docs, odd, none, tmp_path):
    empty = spark.createDataFrame([(10**9, 0, 0)], "doc_id bigint, quality int, toxic int")
    empty.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (docs, odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, rows = rows, corpus_pipeline.cut_lineage(stage(spark, rows, str(tmp_path)))
            assert rows.columns == before.columns, name
            # no stage but the join can lose a row that holds no toxic term, and the mix takes from each source
            assert rows.count() == before.count() or name in ("near_duplicates", "mixing"), name
        corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)).collect()
    classes = brute_components(corpus())
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {d for d, (n, c) in classes.items() if n == 0 or c == d}


def test_pipeline_run(spark, tmp_path):
    """Each stage against brute force on what its predecessor kept, and the whole run against the stages."""
    told, labels, truth = labelled(spark, "toxic")
    extra = [(1000 + r[0], *r[1:]) for r in corpus()]
    told.dropDuplicates(["doc_id"]).unionByName(spark.createDataFrame(extra, SCHEMA)).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    held, rows = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        rows = corpus_pipeline.cut_lineage(stage(spark, rows, str(tmp_path)))
        held[name] = [tuple(r) for r in rows.collect()]
    start = sorted(tuple(r) for r in docs.collect())
    clean = {r["doc_id"] for r in toxicity.classify(docs, labels).where("predicted = 0").collect()}
    assert sorted(held["toxicity"]) == [r for r in start if r[0] in clean]
    assert np.mean([(d not in clean) == bool(y) for d, y in truth.items()]) > 0.97 and {r[0] for r in extra} <= clean
    classes = brute_components(held["toxicity"])
    assert sorted(held["near_duplicates"]) == sorted(r for r in held["toxicity"] if classes[r[0]][0] == 0 or classes[r[0]][1] == r[0])
    cut = brute_repeats(held["near_duplicates"])
    assert sum(n for _, n, _, _ in cut.values()) > 1000
    before = {r[0]: r for r in held["near_duplicates"]}
    assert {r[0] for r in held["suffix_dedup"]} == set(before) and len(held["suffix_dedup"]) == len(before)
    for r in held["suffix_dedup"]:
        assert hashlib.sha256(r[1].encode()).hexdigest() == cut[r[0]][3] and r[4] == len(r[1]) and r[2:4] + r[5:] == before[r[0]][2:4] + before[r[0]][5:]
    kept = spark.createDataFrame(held["suffix_dedup"], SCHEMA)
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_documents(kept).collect() if r["size"]}
    mixed = Counter(held["mixing"])
    sized = {r[0]: r for r in held["suffix_dedup"] if re.search(r"[^\x20\x09-\x0d]", r[1])}
    assert {r[0]: n for r, n in mixed.items() if r[0] in sized} == {d: n for d, n in copies.items() if n}
    assert set(mixed) <= set(held["suffix_dedup"]) and sum(copies.values()) > 100
    want = Counter()
    for doc, ids in token_ids(held["mixing"]):
        for piece, at in enumerate(range(0, len(ids), 4096)):
            want[doc, piece, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())] += 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r) for r in rows.select(*columns).collect()) == want
    places = {}
    for r in rows.collect():
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        ends = [sum(n for _, n in sorted(spans)[:k]) for k in range(len(spans) + 1)]
        assert [at for at, _ in sorted(spans)] == ends[:-1] and ends[-1] <= 4096
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select(*columns).collect()) == want


def test_words_that_share_power_of_two_hashes(spark):
    """Thue-Morse words: their polynomials agree modulo every power of two."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{word} {other}"), (2, f"x {word}"), (3, f"x {other}"), (4, word), (5, other)]
    table = spark.createDataFrame([(*r, "en", "s", 0, "", "", "") for r in rows], SCHEMA)
    want = {d: zlib.crc32(ids.tobytes()) for d, ids in token_ids(rows)}
    assert {r["doc_id"]: r["ids_crc32"] for r in token_files.read_files(token_files.write_files(table, queries.vocabulary())).collect()} == want
    assert {r["doc_id"]: r["ids_crc32"] for r in packing.pack(packing.token_pieces(table, queries.vocabulary())).collect()} == want
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(table).collect()} == {d: d for d in want}
    prints = {r["doc_id"]: r["fingerprint"] for r in simhash.add_fingerprint(table).collect()}
    assert prints[2] != prints[3] and prints[4] != prints[5]
    hashes = [toxicity._word_hash(w) for w in (word, other)]
    assert hashes[0] != hashes[1]
