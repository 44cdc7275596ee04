"""Which wafers skipped a step: by explicit rule blocks, or from the order wafers pass steps.

A wafer without the step is pending (null), skipped ("SKIP") or suspicious (reported only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.functions import aggregates
from waferline.functions.conditions import met
from waferline.operators.features import ORDER, WAFER
from waferline.operators.ranking import first_texts

# The least number of wafers that passed both steps, and the least share of them
# that passed the other step later.
MIN_SUPPORT = 5
AFTER_SHARE = 0.8


def last_per_step(event: DataFrame) -> DataFrame:
    """Last non-null recipe and last time per wafer and step."""
    recipe = aggregates.last_where(F.col("ppid").isNotNull(), F.col("ppid"), [F.col(c) for c in ORDER])
    return event.groupBy(*WAFER, "step_id", "step_desc").agg(
        recipe.alias("ppid"), F.max("tkout_time").alias("t")
    )


def last_split(event: DataFrame) -> DataFrame:
    split = F.col("split")
    last = aggregates.last_where(split.isNotNull(), split, [F.col(c) for c in ORDER])
    return event.groupBy(*WAFER).agg(last.alias("split"))


def candidates(last: DataFrame, feature_steps: DataFrame) -> DataFrame:
    """(wafer, feature) pairs where the wafer has no event at any step of the feature.

    ``feature_steps`` has vehicle, feature and step_id. A wafer's passed features are gathered and taken from
    its vehicle's; rows grow with the result, and the plan with nothing.
    """
    marks = feature_steps.select("vehicle", "step_id", "feature").distinct()
    passed = last.join(marks, ["vehicle", "step_id"], "left").groupBy(*WAFER).agg(F.collect_set("feature").alias("passed"))
    wanted = marks.groupBy("vehicle").agg(F.collect_set("feature").alias("wanted"))
    rows = passed.join(wanted, "vehicle")
    return rows.select(*WAFER, F.explode(F.array_except("wanted", "passed")).alias("feature"))


def without_value(missing: DataFrame, features: DataFrame) -> DataFrame:
    """Candidates that have no feature row either."""
    return missing.join(features.select(*WAFER, "feature"), [*WAFER, "feature"], "left_anti")


def usable_blocks(conditions: DataFrame, targets: DataFrame, known: DataFrame, vehicles: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SKIP blocks per vehicle whose condition steps are all known, what they target, and the others with a reason.

    ``known`` holds (vehicle, name) with step descriptions and step ids. Returns the conditions (vehicle, block,
    step, op, value), the targets (vehicle, block, first, rule, n_conds, feature), and refused (vehicle, rule, reason);
    ``first`` is the position of a block's first condition.
    """
    rows = conditions.withColumn("rule", F.concat_ws("/", "feature", "rule_order"))
    other = F.upper("category") != "SKIP"
    refused = rows.where(other).select(F.lit("").alias("vehicle"), "rule", F.lit("only SKIP blocks are supported").alias("reason")).distinct()
    per_vehicle = rows.where(~other).withColumn("vehicle", F.explode(F.array(*[F.lit(v) for v in vehicles]).cast("array<string>")))
    names = known.select("vehicle", F.col("name").alias("step")).distinct()
    unknown = per_vehicle.join(names, ["vehicle", "step"], "left_anti").groupBy("vehicle", "rule").agg(F.min_by("step", "pos").alias("step"))
    refused = refused.unionByName(unknown.select("vehicle", "rule", F.concat(F.lit("unknown step "), "step").alias("reason")))
    usable = per_vehicle.join(unknown.select("vehicle", "rule"), ["vehicle", "rule"], "left_anti").withColumnRenamed("rule", "block")
    blocks = usable.groupBy("vehicle", "block", "feature").agg(F.min("pos").alias("first"), F.count("*").alias("n_conds"))
    named = targets.select("feature", F.concat(F.lit("KNOB_"), "step", F.lit("_ppid")).alias("target"))
    aims = blocks.join(named, "feature").select("vehicle", "block", "first", F.col("block").alias("rule"), "n_conds", F.col("target").alias("feature"))
    return usable.select("vehicle", "block", "step", "op", "value"), aims, refused


def targeted(conditions: DataFrame, targets: DataFrame) -> DataFrame:
    """(feature) with a SKIP block, usable or not: the passing order does not decide for them."""
    skips = conditions.where(F.upper("category") == "SKIP").select("feature").distinct()
    named = targets.join(skips, "feature", "left_semi")
    return named.select(F.concat(F.lit("KNOB_"), "step", F.lit("_ppid")).alias("feature")).distinct()


def by_rule(last: DataFrame, missing: DataFrame, conditions: DataFrame, aims: DataFrame) -> DataFrame:
    """Candidates whose wafer meets every condition of a block that targets the feature's step.

    Of several such blocks the first one counts. A wafer meets a block if it meets as many conditions as the
    block has. A condition sees the last recipe at its step (named by description or id), null where the wafer
    has none; so those that hold for null are met unless a row says otherwise, and only rows at the
    conditions' steps are compared.
    """
    conditions = conditions.withColumn("of_null", met("op", "value", F.lit(None).cast("string")).cast("int"))
    steps = conditions.select("vehicle", F.col("step").alias("name")).distinct()
    name = F.explode(F.array_distinct(F.array("step_desc", "step_id"))).alias("name")
    here = last.select(*WAFER, "t", "step_id", "ppid", name).join(steps, ["vehicle", "name"])
    values = here.groupBy(*WAFER, "name").agg(F.max(F.struct("t", "step_id", "ppid"))["ppid"].alias("v"))
    seen = values.join(conditions.withColumnRenamed("step", "name"), ["vehicle", "name"])
    change = seen.groupBy(*WAFER, "block").agg(F.sum(met("op", "value", "v").cast("int") - F.col("of_null")).alias("change"))
    held = conditions.groupBy("vehicle", "block").agg(F.sum("of_null").alias("of_null"))
    tried = missing.join(aims, ["vehicle", "feature"]).join(held, ["vehicle", "block"]).join(change, [*WAFER, "block"], "left")
    whole = tried.where(F.col("of_null") + F.coalesce("change", F.lit(0)) == F.col("n_conds"))
    return whole.groupBy(*WAFER, "feature").agg(F.min(F.struct("first", "rule"))["rule"].alias("rule"))


def copassage(last: DataFrame, feature_steps: DataFrame) -> DataFrame:
    """Per feature and other step: wafers that passed both, and the share that passed it later.

    ``feature_steps`` has vehicle, feature and step_id. A wafer's features with their last times are gathered
    and joined to its steps by wafer; counts are combined before anything is shuffled by feature and step.
    """
    marks = feature_steps.select("vehicle", "feature", "step_id").distinct()
    times = last.join(marks, ["vehicle", "step_id"]).groupBy(*WAFER, "feature").agg(F.max("t").alias("ref"))
    times = times.groupBy(*WAFER).agg(F.collect_list(F.struct("feature", "ref")).alias("refs"))
    rows = last.select(*WAFER, "step_id", "t").join(times, WAFER)
    rows = rows.select("vehicle", "step_id", "t", F.inline("refs"))
    # a null time is no comparison: a wafer, but not in the share
    share = F.avg((F.col("t") > F.col("ref")).cast("double")).alias("share")
    sums = rows.groupBy("vehicle", "feature", "step_id").agg(F.count("*").alias("n"), share)
    return sums.join(marks, ["vehicle", "feature", "step_id"], "left_anti")


def anchors(stats: DataFrame, min_support: int = MIN_SUPPORT, after_share: float = AFTER_SHARE) -> DataFrame:
    return stats.where((F.col("n") >= min_support) & (F.col("share") >= after_share))


def by_order(last: DataFrame, missing: DataFrame, anchor_steps: DataFrame) -> DataFrame:
    """Candidates whose wafer already passed a step that comes after the feature's step."""
    passed = last.join(anchor_steps.select("vehicle", "feature", "step_id"), ["vehicle", "step_id"])
    passed = passed.select(*WAFER, "feature").distinct()
    return missing.join(passed, [*WAFER, "feature"], "left_semi")


def report(skips: DataFrame, splits: DataFrame) -> DataFrame:
    """Skipped wafers per feature, mode and the wafer's last split, with the first five lots."""
    keys = ["vehicle", "split", "feature", "mode"]
    rows = skips.join(splits, WAFER, "left").withColumn("split", F.coalesce("split", F.lit("")))
    counts = rows.groupBy(*keys).agg(
        F.count("*").alias("n_wafers"), F.count_distinct("root_lot_id").alias("n_lots")
    )
    return counts.join(first_texts(rows, keys, "root_lot_id", 5, "lots"), keys, "left")
