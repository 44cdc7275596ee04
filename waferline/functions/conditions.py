"""Rule conditions and check filters as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waferline.functions.text import as_col, is_blank


def condition(op: str, value: str, c: str | Column) -> Column:
    """A rule condition. A null value fails all of them but ``_null``; an unknown operator holds."""
    v = as_col(c)
    choices = (value or "").split("|")
    tests = {
        "eq": lambda: v == value,
        "neq": lambda: v != value,
        "contains": lambda: v.rlike(value),
        "in": lambda: v.isin(choices),
        "not_in": lambda: ~v.isin(choices),
        "_null": lambda: v.isNull(),
        "not_null": lambda: v.isNotNull(),
    }
    if op not in tests:
        return F.lit(True)
    return F.coalesce(tests[op](), F.lit(False))


def met(op: str | Column, value: str | Column, c: str | Column) -> Column:
    """The same conditions where operator and value are columns: rules as rows rather than as a plan."""
    v, wanted, kind = as_col(c), F.coalesce(as_col(value), F.lit("")), as_col(op)
    listed = F.array_contains(F.split(wanted, r"\|"), F.coalesce(v, F.lit("")))
    test = (
        F.when(kind == "eq", v == as_col(value)).when(kind == "neq", v != as_col(value)).when(kind == "contains", F.rlike(v, wanted))
        .when(kind == "in", v.isNotNull() & listed).when(kind == "not_in", v.isNotNull() & ~listed)
        .when(kind == "_null", v.isNull()).when(kind == "not_null", v.isNotNull()).otherwise(F.lit(True))
    )
    return F.coalesce(test, F.lit(False))


def check_filter(c: str | Column, check: str | None) -> Column:
    """Filter of a check text: eq X, not null, null, startswith X, contains X; else no filter."""
    text = (check or "").strip().lower()
    trimmed = F.trim(as_col(c).cast("string"))
    upper = F.upper(trimmed)
    if text.startswith("eq "):
        test = upper == text[3:].strip().upper()
    elif text == "not null":
        test = ~is_blank(trimmed)
    elif text == "null":
        test = is_blank(trimmed)
    elif text.startswith("startswith"):
        test = upper.startswith(text[len("startswith") :].strip().upper())
    elif text.startswith("contains"):
        test = upper.rlike(text[len("contains") :].strip().upper())
    else:
        return F.lit(True)
    return F.coalesce(test, F.lit(False))
