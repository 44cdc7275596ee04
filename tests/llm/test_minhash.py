"""MinHash, odd sketches and near duplicates against brute force."""

import random
import re

import numpy as np
import pytest

from waferline.llm import minhash
from waferline.llm.words import mix, text_sets

SCHEMA = "doc_id bigint, text string, set_id string, root int, key string, n string"


def shingles(text, size=2):
    found = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))) if found else frozenset()


def brute(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    links = 0
    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * same >= 80 * len(sets[a] | sets[b]):
                links += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}, links


def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    tm = "a"
    for _ in range(10):
        tm += tm.translate(str.maketrans("ab", "ba"))
    texts = [None, "", " \n", "one", "One", "one two", "ONE two", "two one", tm, tm.translate(str.maketrans("ab", "ba")), "é ü", "É ü"]
    base = [[rng.choice(words) for _ in range(rng.choice([4, 9, 25, 60, 150]))] for _ in range(15)]
    texts.append(" ".join(rng.choice(words) for _ in range(30_000)))
    texts.append(texts[-1] + " and a few more")
    for _ in range(330):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, len(own) // 12, len(own) // 8])):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    drift = [rng.choice(words) for _ in range(80)]
    for i in range(60):  # a chain: neighbours are linked, the ends are not
        drift[i] = f"new{i}"
        texts.append(" ".join(drift))
    return [(7 * i, t, "clash", 1, "clash", "clash") for i, t in enumerate(texts)]


def test_whole_table(spark):
    rows = corpus()
    want, links = brute(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == want and links > 500


def test_odd_rows(spark):
    rows = corpus()[:60]
    odd = [*rows, *rows[5:25], *[(None, *r[1:]) for r in rows[12:30]], (None, "alone in the world here", *rows[0][2:])]
    found = minhash.near_duplicates(spark.createDataFrame(odd, SCHEMA)).collect()
    assert len(found) == len(odd)
    want, _ = brute(rows)
    assert all(r["component_id"] == want[r["doc_id"]][1] for r in found if r["doc_id"] is not None)
    assert [r["component_id"] for r in found if r["doc_id"] is None and r["n_shingles"] == 4] == [None]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("share", [0.5, 0.8, 0.9, 0.97])
def test_samples_and_sketches_estimate(share):
    rng = np.random.default_rng(4)
    count = minhash.BANDS * minhash.ROWS
    agreed, bits = [], []
    for _ in range(200):
        both = round(900 * share)
        pool = mix(rng.integers(0, 2**62, 900).astype(np.uint64))
        left, right = np.sort(pool[: both + (900 - both) // 2]), np.sort(np.concatenate([pool[:both], pool[both + (900 - both) // 2 :]]))
        found = minhash.samples(np.concatenate([left, right]), np.array([0, len(left), len(left) + len(right)]))
        agreed.append((found[0] == found[1]).mean())
        a, b = minhash.odd_sketches(found)
        bits.append(int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
    size = 64 * minhash.SKETCH_WORDS
    estimate = 1 + size / (4 * count) * np.log(1 - 2 * np.array(bits) / size)
    true = round(900 * share) / 900
    assert abs(np.mean(agreed) - true) < 0.01 and abs(np.mean(estimate) - true) < 0.015
    if share >= 0.8:
        assert max(bits) <= minhash.most_different_bits()
    if share == 0.5:
        assert min(bits) > minhash.most_different_bits()


def test_bands_and_parity():
    values, cuts = text_sets(np.frombuffer(b"a b c d e f a b c d e g", np.uint8), np.array([0, 11, 23]), 2)
    found = minhash.samples(values, cuts)
    keys = minhash.band_keys(found)
    for band in range(minhash.BANDS):
        own = slice(band * minhash.ROWS, (band + 1) * minhash.ROWS)
        assert (keys[0, band] == keys[1, band]) == (found[0, own] == found[1, own]).all()
    assert len(np.unique(keys[0])) == minhash.BANDS
    assert (np.bitwise_count(minhash.odd_sketches(found).view(np.uint64)).sum(axis=1) % 2 == minhash.BANDS * minhash.ROWS % 2).all()
