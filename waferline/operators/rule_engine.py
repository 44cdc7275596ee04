"""Ordered rules over the wafer matrix: the first block that holds sets the category.

Rules are configuration: they become one projection per dependency depth, with no loop over rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.functions.conditions import condition

FALLBACK = "RO"


def dependencies(rules: list[dict]) -> dict[str, set[str]]:
    """Features named inside another feature's step descriptions."""
    names = {r["feature_name"].strip().upper() for r in rules}
    out: dict[str, set[str]] = {n: set() for n in names}
    for r in rules:
        feature = r["feature_name"].strip().upper()
        step = (r["step_desc"] or "").upper()
        out[feature] |= {n for n in names if n != feature and n in step}
    return out


def depths(rules: list[dict]) -> dict[str, int]:
    """Depth of each feature: 0 without parents, else one more than its deepest parent."""
    left = dependencies(rules)
    done: dict[str, int] = {}
    while left:
        ready = [f for f, parents in left.items() if parents <= done.keys()]
        if not ready:
            raise ValueError(f"features depend on each other: {', '.join(sorted(left))}")
        for f in ready:
            done[f] = max((done[p] + 1 for p in left[f]), default=0)
        left = {f: p for f, p in left.items() if f not in done}
    return done


def _step_column(step: str | None, columns: set[str]) -> str | None:
    name = (step or "").strip().upper()
    if name in columns:
        return name
    return f"{name}_PPID" if f"{name}_PPID" in columns else None


def _feature(feature: str, rules: list[dict], columns: set[str]) -> Column:
    own = [r for r in rules if r["feature_name"].strip().upper() == feature]
    blocks: dict[int, list[dict]] = {}
    for r in own:
        if r["rule_order"] != FALLBACK:
            blocks.setdefault(int(re.search(r"\d+", r["rule_order"]).group()), []).append(r)
    choices = []
    for number in sorted(blocks):
        test = F.lit(True)
        for r in blocks[number]:
            col = _step_column(r["step_desc"], columns)
            test = test & (condition(r["operator"], r["value"], F.col(col)) if col else F.lit(False))
        choices.append(F.when(test, F.lit(blocks[number][0]["category"])))
    fallback = [r for r in own if r["rule_order"] == FALLBACK]
    if fallback:
        found = [_step_column(r["step_desc"], columns) for r in fallback]
        cols = [c for c in found if c]
        # a missing recipe shows as the text None in a signature; the wide cleanup blanks it
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols]
        choices.append(F.concat_ws("_", *parts) if parts else F.lit(fallback[0]["category"]))
    return F.coalesce(*choices) if choices else F.lit(None).cast("string")


def evaluate(matrix: DataFrame, rules: list[dict]) -> DataFrame:
    """The matrix with one column per feature, parents before children."""
    level = depths(rules)
    out = matrix.select(*[F.col(c).alias(c.upper()) for c in matrix.columns])
    for depth in sorted(set(level.values())):
        columns = set(out.columns)
        new = {f: _feature(f, rules, columns) for f in sorted(level) if level[f] == depth}
        out = out.withColumns(new)
    return out
