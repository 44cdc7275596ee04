"""Recipe-to-category (knob) maps, their lookup, and the condition blocks of the rule form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.functions.registry import Registry
from waferline.functions.text import is_blank
from waferline.operators.features import ORDER, WAFER, text_values
from waferline.operators.ranking import first_texts

# A missing rule number sorts last; the fallback rule; the texts that switch a rule on.
NO_RULE_NUMBER = 1_000_000
FALLBACK = "RO"
USED = ("", "Y", "1", "TRUE")

RULE_COLUMNS = ["feature_name", "function_step", "rule_order", "operator", "value", "category", "use", "agg"]


def _text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def rule_number() -> Column:
    digits = F.nullif(F.regexp_extract(F.coalesce("rule_order", F.lit("")), r"(\d+)", 1), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(NO_RULE_NUMBER))


def in_use() -> Column:
    return F.upper(_text("use")).isin(*USED)


def block_sizes(rules: DataFrame) -> DataFrame:
    """Each rule row with the number of rows sharing its feature and rule order.

    A count joined back, since a window would bring a whole block into one task.
    """
    key = ["feature_name", "rule_order"]
    sizes = rules.groupBy(*key).agg(F.count("*").alias("block_rows")).alias("s")
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    return rules.alias("r").join(sizes, on).select("r.*", "s.block_rows")


def map_from_rules(rules: DataFrame, step_map: DataFrame) -> DataFrame:
    """Single-row eq rules with a value and a category, joined to the steps of their function step.

    A repeated recipe of a step takes the lowest rule number, then the earliest row.
    """
    cols = [c for c in rules.columns if c not in ("feature_name", "rule_order")]
    grouped = rules.groupBy("feature_name", "rule_order").agg(
        F.count("*").alias("n"), F.min(F.struct("pos", *[c for c in cols if c != "pos"])).alias("row")
    )
    single = grouped.where("n = 1").select("rule_order", "row.*")
    single = single.where(
        in_use()
        & (_text("operator") == "eq")
        & (F.upper(_text("rule_order")) != FALLBACK)
        & (_text("value") != "")
        & (_text("category") != "")
    )
    single = single.select(
        rule_number().alias("rule_num"), "pos", _text("function_step").alias("step_desc"),
        F.col("value").alias("ppid"), F.col("category").alias("knob"), "agg",
    )
    steps = step_map.select("vehicle", "step_id", "step_desc").distinct()
    joined = steps.join(single, "step_desc")
    best = F.min(F.struct("rule_num", "pos", "step_desc", "knob", "agg")).alias("best")
    return joined.groupBy("vehicle", "step_id", "ppid").agg(best).select(
        "vehicle", "step_id", "best.step_desc", "ppid", "best.knob", "best.agg", "best.rule_num", "best.pos"
    )


def map_from_pairs(pairs: DataFrame) -> DataFrame:
    """The direct form (vehicle, step_id, step_desc, ppid, knob, agg, pos): a repeat's last row counts."""
    last = F.max(F.struct("pos", "step_desc", "knob", "agg")).alias("best")
    return pairs.groupBy("vehicle", "step_id", "ppid").agg(last).select(
        "vehicle", "step_id", "best.step_desc", "ppid", "best.knob", "best.agg",
        F.lit(0).cast("bigint").alias("rule_num"), "best.pos",
    )


def mapped_steps(knob_map: DataFrame) -> DataFrame:
    """Per mapped step: its description, aggregate (the first one set, else last) and map order."""
    order = F.struct("rule_num", "pos")
    agg = F.min(F.when(~is_blank("agg"), F.struct("rule_num", "pos", F.trim("agg").alias("agg"))))["agg"]
    return knob_map.groupBy("vehicle", "step_id").agg(
        F.min(F.struct("rule_num", "pos", "step_desc"))["step_desc"].alias("step_desc"),
        F.coalesce(agg, F.lit("last")).alias("agg"),
        F.min(order).alias("map_order"),
    )


def lookup(event: DataFrame, knob_map: DataFrame) -> DataFrame:
    """Event rows at mapped steps with ``knob``, null where the recipe is not mapped."""
    rows = event.drop("step_desc").join(mapped_steps(knob_map), ["vehicle", "step_id"])
    pairs = knob_map.select("vehicle", "step_id", "ppid", "knob")
    return rows.join(pairs, ["vehicle", "step_id", "ppid"], "left")


def misses(looked_up: DataFrame) -> DataFrame:
    """Recipes without a category per split and step: lots, wafers and the first five lots."""
    keys = ["vehicle", "split", "step_id", "step_desc", "ppid"]
    rows = looked_up.where(F.col("knob").isNull())
    rows = rows.withColumn("ppid", F.coalesce("ppid", F.lit("")))
    counts = rows.groupBy(*keys).agg(
        F.count_distinct("root_lot_id").alias("n_lots"), F.count_distinct("wafer_id").alias("n_wafers")
    )
    return counts.join(first_texts(rows, keys, "root_lot_id", 5, "lots"), keys, "left")


def winners(looked_up: DataFrame) -> DataFrame:
    """Of several steps with events that share a description, the one later in the map."""
    present = looked_up.groupBy("vehicle", "step_id", "step_desc").agg(F.max("map_order").alias("map_order"))
    last = F.max(F.struct("map_order", "step_id"))["step_id"].alias("step_id")
    return present.groupBy("vehicle", "step_desc").agg(last)


def aggregates_used(rows: list[dict], registry: Registry) -> tuple[list[str], list[dict]]:
    """Known aggregates that rules ask for (none set: last), and the rules skipped with a reason."""
    names = {(r.get("step_desc") or r.get("function_step") or "", (r.get("agg") or "").strip() or "last") for r in rows}
    skipped = [
        {"feature": f"KNOB_{step.strip()}_ppid", "reason": f"unknown aggregate {agg}"}
        for step, agg in sorted(names) if registry.text_agg(agg) is None
    ]
    return sorted({agg for _, agg in names if registry.text_agg(agg)}), skipped


def features(looked_up: DataFrame, registry: Registry, aggs: list[str]) -> DataFrame:
    """One value per wafer and description: the category, else the recipe itself.

    ``aggs`` names the aggregates the map uses; steps with any other one have no feature.
    """
    rows = looked_up.join(winners(looked_up), ["vehicle", "step_desc", "step_id"], "left_semi")
    rows = rows.select(
        *WAFER, *ORDER, "agg", F.concat(F.lit("KNOB_"), "step_desc", F.lit("_ppid")).alias("feature"),
        F.coalesce("knob", "ppid").alias("val"),
    )
    return text_values(rows, {a: registry.text_agg(a) for a in aggs})


def _prepared(rules: DataFrame) -> DataFrame:
    return rules.where(in_use()).select(
        _text("feature_name").alias("feature"), _text("function_step").alias("step"),
        F.upper(_text("rule_order")).alias("rule_order"), _text("operator").alias("op"),
        _text("value").alias("value"), _text("category").alias("category"), "pos",
    )


def block_conditions(rules: DataFrame) -> DataFrame:
    """AND blocks, one row per condition, with the block's category (its first one set) and size.

    A block is several rows of one feature and rule order, or a single row that is not eq.
    """
    rows = _prepared(rules).where(F.col("rule_order") != FALLBACK)
    blocks = rows.groupBy("feature", "rule_order").agg(
        F.count("*").alias("n_conds"),
        F.min(F.when(F.col("category") != "", F.struct("pos", "category")))["category"].alias("block_category"),
        F.min("op").alias("any_op"),
    )
    blocks = blocks.where("n_conds > 1 or any_op <> 'eq'").drop("any_op")
    joined = rows.drop("category").join(blocks, ["feature", "rule_order"])
    return joined.withColumn("category", F.coalesce("block_category", F.lit(""))).drop("block_category")


def block_targets(rules: DataFrame) -> DataFrame:
    """Per feature, the steps its values come from: eq rows with a category, and fallback rows."""
    is_value = (
        F.col("rule_order").rlike(r"^R\d+$") & (F.col("op") == "eq")
        & (F.col("category") != "") & (F.upper("category") != "SKIP")
    )
    rows = _prepared(rules).where(((F.col("rule_order") == FALLBACK) | is_value) & (F.col("step") != ""))
    return rows.select("feature", "step").distinct()
