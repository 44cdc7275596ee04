"""The long feature table: one row per wafer and feature, one pass per source."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.functions import aggregates
from waferline.functions.registry import Registry
from waferline.functions.text import is_blank
from waferline.functions.values import FORCED_AGG
from waferline.operators.ranking import by_hash, dense_positions
from waferline.sources import rules as rule_tables

ORDER = ["tkout_time", "arrival"]
WAFER = ["vehicle", "root_lot_id", "wafer_id"]
WAFER_FEATURE = [*WAFER, "feature"]


@dataclass(frozen=True)
class TextRule:
    feature: str
    step_desc: str
    value: str
    agg: str


@dataclass(frozen=True)
class NumberRule:
    feature: str
    item: str
    agg: str


def fab_rules(rows: list[dict], registry: Registry) -> tuple[list[TextRule], list[dict], list[dict]]:
    """Usable rules, the ones skipped with a reason, and the aggregates that were overridden."""
    usable, skipped, overrides = [], [], []
    for r in rows:
        feature = f"FAB_{r['step_desc']}_{r['feature_name']}"
        agg = r["agg"]
        forced = FORCED_AGG.get(r["feature_name"])
        if forced and agg != forced:
            overrides.append({"feature": feature, "rule_agg": agg, "applied": forced})
            agg = forced
        if not registry.has_value(r["feature_name"]):
            skipped.append({"feature": feature, "reason": f"unknown value rule {r['feature_name']}"})
        elif registry.text_agg(agg) is None:
            skipped.append({"feature": feature, "reason": f"unknown aggregate {agg}"})
        else:
            usable.append(TextRule(feature, r["step_desc"], r["feature_name"], agg))
    return usable, skipped, overrides


def mask_rules(rows: list[dict], registry: Registry) -> tuple[list[TextRule], list[dict]]:
    usable, skipped = [], []
    for r in rows:
        feature = f"MASK_{r['step_desc']}_reticle"
        if registry.text_agg(r["agg"]) is None:
            skipped.append({"feature": feature, "reason": f"unknown aggregate {r['agg']}"})
        else:
            usable.append(TextRule(feature, r["step_desc"], "reticleall", r["agg"]))
    return usable, skipped


def number_rules(rows: list[dict], kind: str, registry: Registry) -> tuple[list[NumberRule], list[dict]]:
    """Rules of INLINE items or VM sensors."""
    id_col, middle = ("item_id", "") if kind == "INLINE" else ("sensor_id", "residual_")
    usable, skipped = [], []
    for r in rows:
        feature = f"{kind}_{r[id_col]}_{middle}{r['agg']}"
        if registry.number_agg(r["agg"]) is None:
            skipped.append({"feature": feature, "reason": f"unknown aggregate {r['agg']}"})
        else:
            usable.append(NumberRule(feature, r[id_col], r["agg"]))
    return usable, skipped


def add_wafer_rank(event: DataFrame) -> DataFrame:
    """Dense rank of the wafer within (vehicle, step, lot), numbers by value, as ``wafer_rank``."""
    group = ["vehicle", "step_id", "root_lot_id"]
    number = F.trim(F.col("wafer_id").cast("string")).try_cast("bigint").cast("string")
    text = F.when(F.length(number) < 9, F.lpad(number, 9, "0")).otherwise(number)
    keyed = event.withColumn("wafer_key", F.coalesce(text, F.col("wafer_id").cast("string")))
    ranks = dense_positions(keyed, group, "wafer_key", "wafer_rank")
    return keyed.join(ranks, [*group, "wafer_key"], "left").drop("wafer_key")


def text_features(event: DataFrame, rules: list[TextRule], registry: Registry) -> DataFrame:
    """Text features of all rules.

    Rows meet the rules of their step, then one group-by holds one buffer per aggregate in use.
    The two aggregates that collect values, and the rules that need a wafer's rank, run apart on
    their own steps' rows only.
    """
    ranked = [r for r in rules if r.value == "sleuth_order"]
    plain = [r for r in rules if r.value != "sleuth_order"]
    specs = {r.agg: registry.text_agg(r.agg) for r in rules}
    parts = []
    for group in (plain, ranked):
        if not group:
            continue
        source = _rows_of_steps(event, group)
        if group is ranked and "wafer_rank" not in event.columns:
            source = add_wafer_rank(source)
        single = [r for r in group if not specs[r.agg].joins]
        if single:
            own_specs = {r.agg: specs[r.agg] for r in single}
            parts.append(single_value(_ruled_rows(source, single, registry), WAFER_FEATURE, own_specs))
        for joins in ("ordered", "distinct"):
            own = [r for r in group if specs[r.agg].joins == joins]
            if not own:
                continue
            rows = _ruled_rows(_rows_of_steps(source, own), own, registry)
            if joins == "ordered":
                parts.append(aggregates.ordered_join(rows, WAFER_FEATURE, F.col("val"), ORDER, "value_str"))
            else:
                parts.append(aggregates.distinct_join(rows, WAFER_FEATURE, F.col("val"), "value_str"))
    return reduce(DataFrame.unionByName, parts)


def _rows_of_steps(event: DataFrame, rules: list[TextRule]) -> DataFrame:
    # a list of constants reaches the scan of the event table, a join does not
    return event.where(F.col("step_desc").isin(sorted({r.step_desc for r in rules})))


def _ruled_rows(event: DataFrame, rules: list[TextRule], registry: Registry) -> DataFrame:
    """Rows times the rules of their step, with the value each rule asks for."""
    cols = ["step_desc", "feature", "value_rule", "agg"]
    table = rule_tables.table(event.sparkSession, cols, [(r.step_desc, r.feature, r.value, r.agg) for r in rules])
    val = F.lit(None).cast("string")
    for name in sorted({r.value for r in rules}):
        val = F.when(F.col("value_rule") == name, registry.value(name).cast("string")).otherwise(val)
    return event.join(table, "step_desc").select(*WAFER, *ORDER, "feature", "agg", val.alias("val"))


def text_values(rows: DataFrame, specs: dict[str, aggregates.TextAgg]) -> DataFrame:
    """One value per wafer and feature of rows (``agg``, ``val``), by whichever aggregate a row names."""
    single = {n: s for n, s in specs.items() if not s.joins}
    parts = [single_value(rows, WAFER_FEATURE, single)] if single or not specs else []
    for name, spec in sorted(specs.items()):
        own = rows.where(F.col("agg") == name)
        if spec.joins == "ordered":
            parts.append(aggregates.ordered_join(own, WAFER_FEATURE, F.col("val"), ORDER, "value_str"))
        elif spec.joins == "distinct":
            parts.append(aggregates.distinct_join(own, WAFER_FEATURE, F.col("val"), "value_str"))
    return reduce(DataFrame.unionByName, parts)


def single_value(rows: DataFrame, keys: list[str], specs: dict[str, aggregates.TextAgg]) -> DataFrame:
    """One value per group: all aggregates of ``specs`` that keep one row, in one pass.

    A group has one aggregate. All picks share two buffers, the latest and the earliest row by
    grade, however many of them there are; each own aggregate has a buffer of its own.
    """
    order, agg, val = [F.col(c) for c in ORDER], F.col("agg"), F.col("val")
    picks = {n: s.pick for n, s in sorted(specs.items()) if s.pick}
    own = {n: s.own for n, s in sorted(specs.items()) if s.own}
    grade, value = F.lit(0), F.lit(None).cast("string")
    for name, pick in picks.items():
        grade = F.when(agg == name, pick.grade(val)).otherwise(grade)
        value = F.when(agg == name, pick.value(val)).otherwise(value)
    graded = rows.where(agg.isin([*picks, *own])).withColumns({"grade": grade, "picked": value})
    exprs, out = [], F.lit(None).cast("string")
    for side, latest in (("latest", True), ("earliest", False)):
        names = [n for n, p in picks.items() if p.latest == latest]
        if names:
            row = aggregates.pick_row(latest, agg.isin(names), F.col("grade"), F.col("picked"), order)
            exprs.append(row["v"].alias(side))
            out = F.when(agg.isin(names), F.col(side)).otherwise(out)
    for i, (name, expr) in enumerate(own.items()):
        exprs.append(expr(F.when(agg == name, val), order).cast("string").alias(f"own{i}"))
        out = F.when(agg == name, F.col(f"own{i}")).otherwise(out)
    grouped = by_hash(graded, [*keys, "agg"]).agg(*exprs).select(*keys, "agg", out.alias("value_str"))
    dropping = [n for n, s in specs.items() if s.drops_null]
    return grouped.where(~agg.isin(dropping) | F.col("value_str").isNotNull()).drop("agg")


def number_features(
    event: DataFrame, rules: list[NumberRule], item: str, value: str, order: list[str], registry: Registry
) -> DataFrame:
    """Numeric features of all rules in one pass."""
    table = rule_tables.table(
        event.sparkSession, [item, "feature", "agg"], [(r.item, r.feature, r.agg) for r in rules]
    )
    rows = event.join(table, item)
    used = sorted({r.agg for r in rules})
    exprs, out = [], F.lit(None).cast("double")
    for i, name in enumerate(used):
        val = F.when(F.col("agg") == name, F.col(value))
        exprs.append(registry.number_agg(name)(val, [F.col(c) for c in order]).alias(f"a{i}"))
        out = F.when(F.col("agg") == name, F.col(f"a{i}").cast("double")).otherwise(out)
    keys = [*WAFER, "feature"]
    return rows.groupBy(*keys, "agg").agg(*exprs).select(*keys, out.alias("value_num"))


def as_long(features: DataFrame, category: str) -> DataFrame:
    """The common shape of the long table."""
    have = set(features.columns)
    text = F.col("value_str") if "value_str" in have else F.lit(None)
    number = F.col("value_num") if "value_num" in have else F.lit(None)
    return features.select(
        *WAFER, "feature", F.lit(category).alias("category"),
        text.cast("string").alias("value_str"), number.cast("double").alias("value_num"),
    )


def has_value() -> Column:
    """A text that is not blank, or a number."""
    number = F.col("value_num").isNotNull() & ~F.isnan(F.coalesce("value_num", F.lit(0.0)))
    return ~is_blank("value_str") | number


def with_values(long: DataFrame) -> DataFrame:
    """Features without a single value are not kept."""
    kept = long.groupBy("vehicle", "feature").agg(F.max(has_value()).alias("filled")).where("filled")
    return long.join(kept.select("vehicle", "feature"), ["vehicle", "feature"], "left_semi")


def coverage(event: DataFrame, date: str, keys: list[str]) -> DataFrame:
    """Days, first and last date of the events a feature build covers."""
    day = F.col(date)
    return event.groupBy(*keys).agg(
        F.count_distinct(day).alias("days"), F.min(day).alias("first_date"), F.max(day).alias("last_date")
    )


def catalog(long: DataFrame) -> DataFrame:
    """Rows, and the first three wafers' values, per feature of any family; numbers with six decimals."""
    from waferline.operators.ranking import top_rows

    text = F.coalesce("value_str", F.when(F.col("value_num").isNotNull(), F.format_string("%.6f", "value_num")))
    rows = long.groupBy("category", "feature").agg(F.count("*").alias("n_rows"))
    order = [F.col(c) for c in WAFER]
    kept = top_rows(long.withColumn("text", F.coalesce(text, F.lit(""))), ["category", "feature"], order, 3)
    cells = F.array_sort(F.collect_list(F.struct("rank", "text")))
    sample = kept.groupBy("category", "feature").agg(
        F.array_join(F.transform(cells, lambda c: c["text"]), ",").alias("sample")
    )
    return rows.join(sample, ["category", "feature"])
