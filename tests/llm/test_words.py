import random
import re

import numpy as np
import pyarrow as pa
import pytest

from waferline.llm import tokens, words
from waferline.llm.common import text_blocks
from waferline.llm.induced import suffix_array
from waferline.llm.packing import OpenBins, best_fit
from waferline.llm.queries import vocabulary

TEXTS = ["", None, " \n\t", "a", "One two", "one two three four five", "One two three four five six", "É é x　y", "x" * 5000, "a b " * 300]


def test_sets_are_the_distinct_shingles():
    for low, high, data, bounds in text_blocks(pa.array(TEXTS), 64):
        _, cuts = words.text_sets(data, bounds)
        for i in range(low, high):
            plain = re.sub("[A-Z]", lambda m: m[0].lower(), TEXTS[i] or "")
            found = re.findall(r"[^\x20\x09-\x0d]+", plain)
            want = len({tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))}) if found else 0
            assert cuts[i - low + 1] - cuts[i - low] == want


def test_equal_texts_have_equal_sets_wherever_they_stand():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab cd EF gh".split()) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    found = {}
    for low, high, data, bounds in text_blocks(pa.array(texts + texts[::-1]), 300):
        values, cuts = words.text_sets(data, bounds)
        for i in range(high - low):
            text = (texts + texts[::-1])[low + i]
            got = tuple(values[cuts[i] : cuts[i + 1]].tolist())
            assert found.setdefault(text, got) == got


@pytest.fixture(scope="module")
def own():
    return tokens.WordEncoder(vocabulary())


def test_pieces_encode_as_whole_texts_do(own):
    texts = [t or "" for t in TEXTS] + [
        "Hello WORLD's <|endoftext|>x 12áÉ\nΣΑΣ", "Á x\x01y é́a 3½ a<b don't I'LL 1É2", "ÀÉ×÷ßÞÿ.,;3a4 ́b",
        "".join(map(chr, range(1, 600))), "日本語 text🙂..!!", "'s'S ''re", "ÿÝ×a÷b",
    ]
    rng = random.Random(3)
    letters = "aB9.,'<é Ü×\ń 🙂ß"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for low, high, data, bounds in text_blocks(pa.array(texts), 500):
        ids, cuts = own.encode(data, bounds)
        for i in range(low, high):
            want = own.tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
            assert ids[cuts[i - low] : cuts[i - low + 1]].tolist() == want, texts[i]


def test_store_of_pieces_may_overflow(own, monkeypatch):
    monkeypatch.setattr(tokens, "STORE_WORDS", 5)
    data = b"one two three four five six seven"
    ids, _ = own.encode(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert ids.tolist() == own.tokenizer.encode(data.decode(), add_special_tokens=False).ids + [1]


def naive_best_fit(lengths, capacity):
    left = []
    for size in sorted(lengths, reverse=True):
        fits = [r for r in left if r >= size]
        if fits:
            left[left.index(min(fits))] -= size
        else:
            left.append(capacity - size)
    return sorted(left)


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 100):
        lengths = rng.integers(1, capacity + 1, 300)
        bins, offset = best_fit(lengths, capacity)
        fill = np.bincount(bins, weights=lengths)
        assert sorted((capacity - fill).tolist()) == naive_best_fit(lengths.tolist(), capacity)
        for b in range(bins.max() + 1):
            mine = np.flatnonzero(bins == b)
            mine = mine[np.argsort(offset[mine])]
            assert offset[mine].tolist() == (np.cumsum(lengths[mine]) - lengths[mine]).tolist()


def test_open_bins():
    tree = OpenBins(10)
    for b, left in enumerate([3, 10, 7]):
        tree.put(b, left)
    assert tree.tightest(4) == (2, 7) and tree.tightest(4) == (1, 10) and tree.tightest(4) is None and tree.tightest(3) == (0, 3)


def shared(t, a, b):
    k = 0
    while a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
        k += 1
    return k


@pytest.mark.parametrize("base, spill", [(1 << 20, 1 << 18), (2, 1 << 18), (2, 3)])
def test_suffix_array_and_prefixes(base, spill):
    rng = np.random.default_rng(base + spill)
    for trial in range(60):
        t = rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(1, 90)))
        t = np.append(np.tile(t, 1 + trial % 3), 0).astype(np.uint16)
        limit = 10_000 if trial % 2 else 8
        out = list(suffix_array(t, limit, base=base, spill=spill))
        down = np.concatenate([p for p, _ in out]).tolist()
        key = lambda i: t[i : i + limit].tolist()  # noqa: E731, B023
        assert [key(i) for i in down] == [key(i) for i in sorted(range(len(t)), key=key, reverse=True)]
        assert sorted(down) == list(range(len(t)))
        want = [0] + [min(limit, shared(t, a, b)) for a, b in zip(down, down[1:])]
        assert np.concatenate([x for _, x in out]).tolist() == want


def test_thue_morse_words_differ():
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{word} {other}".encode(), np.uint8)
    starts, ends, _ = words.spans(data, np.array([0, len(data)]))
    left, right = words.word_hashes(data, starts, ends).tolist()
    assert left != right


def test_hashes_do_not_depend_on_place_or_chunk(monkeypatch):
    data = np.frombuffer(b"some words of a text that stands twice, longest " * 2, np.uint8)
    starts, ends, _ = words.spans(data, np.array([0, len(data)]))
    whole = words.word_hashes(data, starts, ends)
    assert (whole[: len(whole) // 2] == whole[len(whole) // 2 :]).all()
    monkeypatch.setattr(words, "_CHUNK", 3)
    monkeypatch.setattr(words, "_LONGEST", 5)
    assert (words.word_hashes(data, starts, ends) == whole).all()


def test_set_ids_do_not_depend_on_neighbours():
    from waferline.llm.jaccard import set_ids

    texts = [b"one two three four five six", b"a b c d e f g h", b"", b"one two three four five six"]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = set_ids(*words.text_sets(np.frombuffer(b"".join(texts), np.uint8), bounds))
    alone = [set_ids(*words.text_sets(np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0] for t in texts]
    assert ids.tolist() == alone and ids[0] == ids[3] and len(set(alone)) == 3


def test_parity_bitmaps_never_differ_more_than_the_sets():
    from waferline.llm.jaccard import parities

    rng = random.Random(3)
    for size in (3, 40, 900, 9000):
        pool = [words.mix(np.array([rng.getrandbits(63)], np.uint64))[0] for _ in range(size + size // 3)]
        left, right = set(pool[:size]), set(pool[size // 3 :])
        a, b = parities(np.array([*left, *right], np.uint64), np.array([0, len(left), len(left) + len(right)])).view(np.uint64)
        assert 0 < int(np.bitwise_count(a ^ b).sum()) <= len(left ^ right)


def test_few_and_many_links(spark, monkeypatch):
    from waferline.llm import components

    rng = random.Random(9)
    links = spark.createDataFrame([(rng.randint(-500, 500), rng.randint(-500, 500)) for _ in range(450)], "a bigint, b bigint")
    few = {r["node"]: r["root"] for r in components.components(links).collect()}
    monkeypatch.setattr(components, "FEW_LINKS", -1)
    assert few == {r["node"]: r["root"] for r in components.components(links).collect()} and len(set(few.values())) > 50
    assert components.components(links.limit(0)).collect() == []
