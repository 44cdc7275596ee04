"""Time-ordered aggregates.

``first`` and ``last`` are the minimum and maximum of a struct (order columns, value): they
combine on the map side and hold one row per group, so a hot group is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.text import VALID_TOOL, VALID_TOOL_LOOSE, clean


def _row(order: list[Column], val: Column) -> Column:
    parts = [o.alias(f"o{i}") for i, o in enumerate(order)]
    return F.struct(*parts, val.alias("v"))


def first(val: Column, order: list[Column]) -> Column:
    return F.min(_row(order, val))["v"]


def last(val: Column, order: list[Column]) -> Column:
    return F.max(_row(order, val))["v"]


def last_where(test: Column, val: Column, order: list[Column]) -> Column:
    return F.max(F.when(test, _row(order, val)))["v"]


@dataclass(frozen=True)
class Pick:
    """An aggregate that keeps one row: the latest of the highest grade, or the earliest of the lowest."""

    latest: bool
    grade: Callable[[Column], Column]
    value: Callable[[Column], Column]

    def expr(self, val: Column, order: list[Column]) -> Column:
        return pick_row(self.latest, F.lit(True), self.grade(val), self.value(val), order)["v"]


def pick_row(latest: bool, test: Column, grade: Column, value: Column, order: list[Column]) -> Column:
    row = F.when(test, _row([grade, *order], value))
    return F.max(row) if latest else F.min(row)


def _upper(val: Column) -> Column:
    return F.upper(F.trim(val.cast("string")))


def _filled(val: Column) -> Column:
    text = _upper(val)
    return F.coalesce(~text.isin("", "-") & ~text.contains("SKIP"), F.lit(False))


def _loose_tool(val: Column) -> Column:
    return F.coalesce(F.trim(val.cast("string")).rlike(VALID_TOOL_LOOSE), F.lit(False))


def _tool_grade(val: Column) -> Column:
    text = clean(val)
    return F.when(text.rlike(VALID_TOOL), 2).when(text.isNotNull(), 1).otherwise(0)


FIRST = Pick(False, lambda val: F.lit(0), lambda val: val)
LAST = Pick(True, lambda val: F.lit(0), lambda val: val)
# last upper-cased value that is not blank, "-" or a SKIP text
LAST_VALID = Pick(True, lambda val: _filled(val).cast("int"), lambda val: F.when(_filled(val), _upper(val)))
# first value of the looser tool form; null without one
VALID_TOOL_FIRST = Pick(
    False,
    lambda val: (~_loose_tool(val)).cast("int"),
    lambda val: F.when(_loose_tool(val), F.trim(val.cast("string"))),
)
# last valid tool value, else the last value that is not blank
VALID_OR_LAST = Pick(True, _tool_grade, clean)


@dataclass(frozen=True)
class TextAgg:
    """An aggregate of a text value: a pick, an own expression, or one of the two joins."""

    pick: Pick | None = None
    own: Callable[[Column, list[Column]], Column] | None = None
    drops_null: bool = False
    joins: str = ""

    def expr(self, val: Column, order: list[Column]) -> Column:
        return self.pick.expr(val, order) if self.pick else self.own(val, order)


TEXT_AGGS = {
    "first": TextAgg(FIRST),
    "last": TextAgg(LAST),
    "last_valid": TextAgg(LAST_VALID),
    "valid_eqp": TextAgg(VALID_TOOL_FIRST, drops_null=True),
    "valid_or_last": TextAgg(VALID_OR_LAST),
    "concat": TextAgg(joins="ordered"),
    "agg": TextAgg(joins="distinct"),
}

NUMBER_AGGS: dict[str, Callable[[Column, list[Column]], Column]] = {
    "mean": lambda val, order: F.avg(val),
    "max": lambda val, order: F.max(val),
    "min": lambda val, order: F.min(val),
    "last": last,
    "first": first,
}


def ordered_join(df: DataFrame, keys: list[str], val: Column, order: list[str], out: str) -> DataFrame:
    """All trimmed non-null values of a group in order, joined by "_"; a group without any gives an empty text.

    Rows are exchanged once: dealt by ranges of (group, order) and sorted, so a hot group spreads over many
    tasks. A task folds its rows as they stream by, a piece of text for each group and batch, and only the
    pieces of a group meet at the end. What meets is the result cell itself.
    """
    fields = [df.select(k).schema.fields[0] for k in keys]
    rows = df.select(*keys, *order, F.trim(val.cast("string")).alias("_value"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    dealt = rows.repartitionByRange(tasks, *bounds).sortWithinPartitions(*bounds)
    dealt = dealt.select(*keys, "_value", F.spark_partition_id().alias("_part"))
    shape = T.StructType([*fields, T.StructField("_part", T.IntegerType()), T.StructField("_batch", T.LongType()), T.StructField("_text", T.StringType())])
    pieces = dealt.mapInArrow(_folded, shape)
    texts = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_part", "_batch", "_text"))))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(texts, lambda c: c["_text"]), "_").alias(out))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of each run of equal keys as one text, a batch at a time; the last two columns are value and part."""
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        *keys, values, part = batch.columns
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for key in keys:
            now, before = key.slice(1), key.slice(0, batch.num_rows - 1)
            # null against null is the same key, null against a value is not
            differ = pc.or_kleene(pc.not_equal(now, before), pc.not_equal(pc.is_null(now), pc.is_null(before)))
            new[1:] |= pc.fill_null(differ, False).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        kept = pc.is_valid(values).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(kept)])
        bounds = np.append(before[starts], before[-1])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values.filter(pa.array(kept)))
        texts = pc.if_else(pa.array(np.diff(bounds) > 0), pc.binary_join(lists, "_"), pa.scalar(None, lists.type.value_type))
        firsts = pa.array(starts)
        columns = [*[k.take(firsts) for k in keys], part.take(firsts), pa.array(np.full(len(starts), number, np.int64)), texts]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "_part", "_batch", "_text"])


def distinct_join(df: DataFrame, keys: list[str], val: Column, out: str) -> DataFrame:
    """Sorted distinct values of a group joined by "_"; repeats go before the shuffle."""
    pairs = df.select(*keys, val.cast("string").alias("v")).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("v")), "_").alias(out))
