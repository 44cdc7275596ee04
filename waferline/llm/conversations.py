"""Repair of conversations: the cheapest edits that make the turns alternate.

The turns of a conversation are aligned with strings of the grammar ``(s?(ua)+)?`` by the Wagner-Fischer
recurrence. All feasible strings have their ends in common, so one table, filled from the last turn and the
last character, holds the alignments with strings of every length: entry (i, k) is the least cost of the
turns from i on against the last k characters. Ukkonen's bound keeps an entry only while it, with the least
cost of the turns before, stays within the cost of a repair that is known already (the incumbent), and
while no other entry of its row with the same strings before it is better. Audits are traced back from
every length of least cost and compared.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from waferline.session import cut_lineage

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Alignments that a task remembers, of conversations up to so many turns.
REMEMBERED, REMEMBERED_TURNS = 50_000, 64
_NEVER = 1 << 60
_SPACES = "\\x20\\x09-\\x0D"


def _incumbent(codes: str) -> int:
    """The cost of a repair that a single walk finds: deletes, keeps what fits, reroles the rest."""
    use = [c for c in codes if c.islower() and c != "x"]
    cost, want = DELETE * (len(codes) - len(use)), "u"
    for own, after in zip(use, use[1:] + [""]):
        if own != want and after == want:
            cost += DELETE
            continue
        cost += REROLE * (own != want)
        want = "a" if want == "u" else "u"
    return min(cost + INSERT * (want == "a"), DELETE * len(codes))


def _keep_cost(code: str, wanted: str) -> int:
    """Keep or rerole a turn for the wanted role."""
    return REROLE * (code.lower() != wanted) + TRUNCATED * code.isupper()


def _wanted(left: int) -> str:
    """The character with which the last ``left`` ones begin."""
    return "ua"[left % 2]


def _table(codes: str, incumbent: int) -> tuple[list[dict[int, str]], dict[int, int], list[str], int]:
    """For each turn the first letter of the best audit by characters left, and the costs of the first turn;
    the same for a leading s that is still to come.

    Entries of a row with the same next character have the same strings before them, so only the cheapest
    one stays, and of equally cheap ones that with the least audit. Audits from a turn on are compared by
    letter and then by the rank of what follows.
    """
    before = [0]
    for code in codes:
        before.append(before[-1] + (0 if code.islower() and code != "x" else DELETE))
    n = len(codes)
    letters: list[dict[int, str]] = [{} for _ in range(n + 1)]
    leading = [""] * (n + 1)
    lead = _NEVER
    row: dict[int, tuple[int, tuple]] = {}
    for i in range(n, -1, -1):
        below = row
        rank = {key: place for place, key in enumerate(sorted({key for _, key in below.values()}))}
        row = {0: (0, ())} if i == n else {}
        if i < n:
            code = codes[i]
            found = [(k, cost + DELETE, ("D", rank[key])) for k, (cost, key) in below.items()]
            if code != "x":
                for k, (cost, key) in below.items():
                    own = _wanted(k + 1)
                    found.append((k + 1, cost + _keep_cost(code, own), ("K" if code.lower() == own else "R", rank[key])))
            for k, cost, key in found:
                row[k] = min(row.get(k, (_NEVER, ())), (cost, key))
            deleted = lead + DELETE
            lead, leading[i] = deleted, "D"
            if code in ("s", "S"):
                kept = TRUNCATED * code.isupper() + min((cost for k, (cost, _) in below.items() if k and k % 2 == 0), default=_NEVER)
                if kept < deleted:
                    lead, leading[i] = kept, "K"
        for k in range(min(row, default=0), max(row, default=-2) + 2):
            if k in row:
                cost, key = row[k]
                row[k + 1] = min(row.get(k + 1, (_NEVER, ())), (cost + INSERT, ("I", *key)))
        # with no characters left only the whole string may come before: such an entry rules out no other
        best = [min((x for k, x in row.items() if k and k % 2 == odd), default=(_NEVER, ())) for odd in (0, 1)]
        row = {k: x for k, x in row.items() if (x <= best[k % 2] if k else x[0] <= best[0][0]) and before[i] + x[0] <= incumbent}
        letters[i] = {k: key[0] if key else "" for k, (_, key) in row.items()}
    return letters, {k: cost for k, (cost, _) in row.items()}, leading, lead


def _traced(codes: str, letters: list[dict[int, str]], leading: list[str], left: int) -> str:
    """The audit of the best alignment with ``left`` characters, or with a leading s if that is negative."""
    audit, i = [], 0
    while left < 0:
        audit.append(leading[i])
        if leading[i] == "K":
            left = max(k for k in letters[i + 1] if k and k % 2 == 0)
        i += 1
    while i < len(codes) or left:
        letter = letters[i][left]
        audit.append(letter)
        i += letter != "I"
        left -= letter != "D"
    return "".join(audit)


def align(codes: str) -> tuple[int, str]:
    """The least cost, and the least by character of all audits (D, I, K, R in order) of that cost.

    A turn's code is its role's initial (o for other ones), a capital if it is truncated, x if it must go.
    """
    letters, costs, leading, lead = _table(codes, _incumbent(codes))
    costs = {k: cost for k, cost in costs.items() if k % 2 == 0} | {-1: lead}
    cost = min(costs.values())
    return cost, min(_traced(codes, letters, leading, k) for k in costs if costs[k] == cost)


@lru_cache(REMEMBERED)
def _remembered(codes: str) -> tuple[int, str]:
    return align(codes)


def repaired_turns(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) left and made by an audit of the turns."""
    role = "user"
    for letter in audit:
        if letter == "I":
            own, text = role, ""
        else:
            own, text = next(turns)
            if letter == "D":
                continue
            own = own if letter == "K" else role
        yield own, text
        # a leading system turn is followed by the user's
        role = "assistant" if own[:1] == "u" else "user"


def damaged(rows: DataFrame) -> DataFrame:
    """The turns after damage, and a row with ``gone`` for each one dropped; null role and text are a space.

    By the crc32 of ``conv_id:turn`` (null: a space) modulo 20: 0 drops a turn, 1 empties its text, 2 takes
    the signs ``.!?`` out of it, 3 repeats it, 4 makes its role user.
    """
    key = F.concat(F.coalesce(rows["conv_id"].cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(rows["turn"].cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role = F.coalesce(rows["role"].cast("string"), F.lit(" "))
    text = F.coalesce(rows["text"].cast("string"), F.lit(" "))
    out = rows.select(
        rows["conv_id"].alias("conv_id"),
        rows["turn"].cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return out.select("*", F.explode(F.sequence(F.lit(1), "times")).alias("copy")).drop("times")


def _fault() -> Column:
    """The fault of a turn that counts: blank, duplicate, truncated, or none, by its initial."""
    blank = ~F.col("text").rlike(f"[^{_SPACES}]")
    ended = F.col("text").rlike(f"[.!?][{_SPACES}]*\\z")
    return F.when(blank, "b").when(F.col("seen") > 1, "d").when(~ended, "t").otherwise("")


_ORDER = ("turn", "role", "digest", "copy")


def _dealt(rows: DataFrame) -> DataFrame:
    """Whole conversations in order, each in one task, which reads them as a stream."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "part", *_ORDER)  # nulls first


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, rows) one after the other; the rows are read as they are asked for."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    return groupby(rows, itemgetter(0))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, 4096)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of the conversations of ``damaged``.

    Texts stay where they are: a turn comes as its role's initial, its fault and a digest that orders ties.
    A turn is a duplicate by a window over equal turns of a conversation, so no task holds what a
    conversation has said. A task holds one character a turn of one conversation, and its table.
    """
    same = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")
    faults = rows.withColumn("seen", F.row_number().over(same)).withColumn("fault", _fault())
    turns = faults.select("conv_id", "turn", "gone", F.substring("role", 1, 1).alias("initial"), "fault", "role", "digest", "copy", F.lit(0).alias("part"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    types = [to_arrow_type(rows.schema["conv_id"].dataType), *[pa.int64()] * len(counts), pa.string()]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, all_ in _conversations(batches):
            codes: list[str] = []
            faults, illegal, last = Counter(), 0, None
            low = high = None
            numbers = 0
            for _, turn, gone, initial, fault in all_:
                if gone:
                    continue
                if turn is not None:
                    low = turn if low is None else low
                    numbers += turn != high
                    high = turn
                faults[fault] += 1
                illegal += last is not None and last + initial not in ("su", "ua", "au")
                last = initial
                code = "x" if fault in ("b", "d") else initial if initial in ("s", "u", "a") else "o"
                codes.append(code.upper() if fault == "t" else code)
            turns = "".join(codes)
            cost, audit = (_remembered if len(turns) <= REMEMBERED_TURNS else align)(turns)
            yield conv, high - low + 1 - numbers if numbers else 0, faults["b"], faults["d"], faults["t"], illegal, cost, audit

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), ["conv_id", *counts, "audit"], types)

    shape = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in counts) + ", audit string"
    return _dealt(turns).select("conv_id", "turn", "gone", "initial", "fault").mapInArrow(walk, shape)


def repair(rows: DataFrame) -> DataFrame:
    """The columns of ``audits`` and ``repaired_sha256`` of every conversation of (conv_id, turn, role, text).

    The digest is of the repaired ``role:text`` joined by newlines; each conversation's texts pass through a
    task after its audit, in order, and are not kept. Turns are ordered by number, nulls first, then by
    role and digest of the text; a null conv_id is a conversation of its own. A conversation that loses all
    turns has zeros, an empty audit and the digest of nothing; an empty table gives no rows. Other columns
    play no part.
    """
    rows = damaged(rows).withColumn("digest", F.unhex(F.sha2("text", 256)))
    found = cut_lineage(audits(rows))
    heads = found.select("conv_id", F.lit(0).alias("part"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in _ORDER], F.col("audit").alias("text"))
    texts = rows.where("NOT gone").select("conv_id", F.lit(1).alias("part"), *_ORDER, "text")
    kind = rows.schema["conv_id"].dataType

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, all_ in _conversations(batches):
            _, _, audit = next(all_)
            digest = hashlib.sha256()
            for i, (role, text) in enumerate(repaired_turns(audit, (row[1:] for row in all_))):
                digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
            yield conv, digest.hexdigest()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(digests(batches), ["conv_id", "repaired_sha256"], [to_arrow_type(kind), pa.string()])

    dealt = _dealt(heads.unionByName(texts)).select("conv_id", "role", "text")
    made = dealt.mapInArrow(walk, f"own {kind.simpleString()}, repaired_sha256 string")
    return found.join(made, found["conv_id"].eqNullSafe(made["own"])).drop("own")
