"""Repair of conversations against a brute-force search, on single code strings and on whole tables."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache
from itertools import product

import pytest

from waferline.llm import conversations


sys.setrecursionlimit(20_000)


def brute(codes):
    """Least cost and least audit by trying every edit from every state of the grammar."""

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(codes) and state in ("", "a"):
            found.append((0, ""))
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 3:
            for role in after.replace("s", ""):
                cost, audit = best(i, role, inserted + 1)
                found.append((cost + 5, "I" + audit))
        if i < len(codes):
            code = codes[i]
            cost, audit = best(i + 1, state, 0)
            found.append((cost + 2, "D" + audit))
            if code != "x":
                cut = 5 * code.isupper()
                for role in after:
                    if code.lower() == role:
                        cost, audit = best(i + 1, role, 0)
                        found.append((cost + cut, "K" + audit))
                    elif role != "s":
                        cost, audit = best(i + 1, role, 0)
                        found.append((cost + cut + 1, "R" + audit))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def test_every_short_conversation():
    for n in range(5):
        for codes in product("suaoxUAS", repeat=n):
            assert conversations.align("".join(codes)) == brute("".join(codes)), codes


def test_longer_conversations():
    rng = random.Random(3)
    for _ in range(600):
        codes = "".join(rng.choice("ssuuuaaaoxxUASO") for _ in range(rng.randint(6, 40)))
        assert conversations.align(codes) == brute(codes), codes


def test_a_very_long_conversation():
    rng = random.Random(4)
    turns = ["ua"[i % 2] for i in range(30_000)]
    for i in rng.sample(range(len(turns)), 6_000):
        turns[i] = rng.choice("uaxUA")
    cost, audit = conversations.align("".join(turns))
    kept, spent = iter(turns), 0
    roles = []
    for letter in audit:
        spent += {"D": 2, "I": 5, "K": 0, "R": 1}[letter]
        if letter != "I":
            own = next(kept)
            spent += 5 * (letter != "D" and own.isupper())
            assert letter == "D" or own != "x"
            if letter != "D":
                roles.append(own.lower() if letter == "K" else "ua"[len(roles) % 2])
        else:
            roles.append("ua"[len(roles) % 2])
    assert spent == cost and next(kept, None) is None and "".join(roles) == "ua" * (len(roles) // 2)


def brute_table(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        own = [r for r in rows if r[0] == conv]
        for _, turn, role, text in own:
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            turns += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        codes, faults = "", [0, 0, 0]
        for i, (_, role, text) in enumerate(turns):
            last = re.search(r"([^\x20\x09-\x0d])[\x20\x09-\x0d]*\Z", text)
            seen = any((role, text) == t[1:] for t in turns[:i])
            fault = 0 if not last else 1 if seen else 2 if last[1] not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in (0, 1) else code.upper() if fault == 2 else code
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        numbers = {t[0] for t in turns if t[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = brute(codes)
        made, rest = [], iter(turns)
        for letter in audit:
            role = "assistant" if made and made[-1][0][:1] == "u" else "user"
            if letter == "I":
                made.append((role, ""))
            else:
                _, own, text = next(rest)
                if letter != "D":
                    made.append((own if letter == "K" else role, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, digest)
    return out


def turns_table():
    rng = random.Random(8)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "utility"]) if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
            text = rng.choice([None, "", "  \n", "One.", "One! \t", "cut", "é…", "x" * 3000 + "?"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(900, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(700)]
    return rows


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_table(spark):
    rows = turns_table()
    schema = "conv_id bigint, turn bigint, role string, text string, audit string, fault int"
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], schema).repartition(5)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in conversations.repair(table).collect()}
    assert got == brute_table(rows)
    repeated = conversations.repair(table.unionByName(table.where("conv_id < 5"))).collect()
    again = brute_table(rows + [r for r in rows if r[0] is not None and r[0] < 5])
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repeated} == again
    assert conversations.repair(table.where("false")).collect() == []


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_id_types(spark, kind):
    rows = [(i, t, "user", f"{t}.") for i in range(30) for t in range(2)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = conversations.repair(table.withColumn("conv_id", table["conv_id"].cast(kind)))
    assert {int(r["conv_id"]): tuple(r[c] for c in COLUMNS) for r in found.collect()} == brute_table(rows)
