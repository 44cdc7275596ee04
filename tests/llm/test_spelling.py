"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from waferline.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n int, root string"


def brute(rows, least=5, letters=6):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least and len(w) >= letters}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    forms, out = {}, {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if o != w and near(w, o))
        takes = others and -others[0][0] >= 5 * n
        forms[w] = others[0][1] if takes else None
        out[w] = [forms[w], n, len(others), -others[0][0] if takes else None]
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].insert(1, root)
    return {w: tuple(x) for w, x in out.items()}


def texts():
    rng = random.Random(2)
    alphabet = "abcdeéÀß"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9))) for _ in range(40)]
    words += ["aaaaaaa", "aaaaaab", "aaaaaabb", "ÿÿÿÿÿÿ", "ÿÿÿÿÿÿÿ", "abcdef", "fedcba", "bacdef", "hoüse×s", "colour", "color", "colours"]
    for word in list(words):
        for _ in range(4):
            at = rng.randrange(len(word))
            words.append(rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(alphabet) + word[at:], word[:at] + rng.choice(alphabet) + word[at + 1 :]]))
    weights = [rng.choice([1, 2, 8, 50, 400]) for _ in words]
    rows = [(None, "colour, colour"), (1, None), (2, ""), (3, "... 123 "), (4, "Colour’COLOUR colour1colour " * 40)]
    for doc in range(5, 400):
        rows.append((doc, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))))
    rows.append((1000, "".join(rng.choices(["colour", "colours", "cölour", ". "], k=9000))))
    return [(*r, "clash", 1, "clash") for r in rows + rows[10:20]]


@pytest.mark.parametrize("limits", [{}, {"HELD_WORDS": 3}, {"SLIP": 7, "LEAST_COUNT": 2}])
def test_groups(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(spelling, name, value)
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    if "SLIP" in limits:  # the workers read the module anew
        words = spark.createDataFrame([(w, n) for w, (_, _, n, _, _) in brute(rows, 2).items()], "word string, n bigint")
        pairs = {(r["a"], r["b"]) for r in spelling.near_pairs(words, parts=4).collect()}
        assert pairs == {(r["a"], r["b"]) for r in spelling.near_pairs(words, parts=11).collect()} and len(pairs) > 50
        return
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variant_groups(docs).collect()}
    want = brute(rows)
    assert got == want and any(r for r, *_ in want.values())


def test_long_chains(spark):
    steps = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(27)], "word string, form string")
    assert {r["root"] for r in spelling.roots(steps).collect()} == {"w27"}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert spelling.variant_groups(docs).collect() == []
    assert spelling.variant_groups(spark.createDataFrame([(1, "once only", "", 1, "")], SCHEMA)).collect() == []
