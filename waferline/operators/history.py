"""Matrices, queue times, item values and outliers from process history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.functions import aggregates
from waferline.functions.text import as_col, clean, column_name
from waferline.operators.features import ORDER, WAFER
from waferline.operators.ranking import exact_median

# An outlier is this many median deviations away; smaller deviations mean no spread.
OUTLIER_DEVIATIONS = 100
LEAST_DEVIATION = 1e-9


def seconds_between(a: str | Column, b: str | Column) -> Column:
    """Whole seconds between two times, never negative."""
    return F.abs(F.unix_seconds(as_col(a).cast("timestamp")) - F.unix_seconds(as_col(b).cast("timestamp")))


def queue_time(
    event: DataFrame, a: str, b: str, newest_by: list[str], exclude_step: str, exclude_recipe: str
) -> DataFrame:
    """Seconds between two times of the newest row per wafer and step.

    Rows without one of the times and one (step, recipe) pair are left out.
    """
    known = F.col("step_desc").isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull()
    known = known & F.col(newest_by[0]).isNotNull()
    excluded = (F.col("step_desc") == exclude_step) & (F.col("ppid") == exclude_recipe)
    rows = event.where(known & ~F.coalesce(excluded, F.lit(False)))
    newest = F.max(F.struct(*newest_by, F.col(a).alias("time_a"), F.col(b).alias("time_b"))).alias("row")
    latest = rows.groupBy(*WAFER, "step_desc").agg(newest)
    feature = F.concat(F.lit("FAB_"), column_name("step_desc"), F.lit("_QTIME"))
    return latest.select(
        *WAFER, feature.alias("feature"), seconds_between("row.time_a", "row.time_b").alias("qtime")
    )


def item_last(event: DataFrame, rules: DataFrame, sub_item: str, prefix: str, order: list[str]) -> DataFrame:
    """Last value per wafer, step and item of the ruled items; zero values are left out."""
    rows = event.join(rules, ["step_desc", "item_id"]).where(F.col("subitem_id") == sub_item)
    last = aggregates.last(F.col("fab_value"), [F.col(c) for c in order]).try_cast("double")
    rows = rows.groupBy(*WAFER, "step_desc", "item_id").agg(last.alias("value")).where("value <> 0")
    feature = F.concat_ws("_", F.lit(prefix), "step_desc", "item_id")
    return rows.select(*WAFER, feature.alias("feature"), "value")


def null_outliers(df: DataFrame, keys: list[str], value: str, n: float = OUTLIER_DEVIATIONS) -> DataFrame:
    """Values further than ``n`` median absolute deviations from the group's median become null."""
    centre = exact_median(df, keys, value, "centre")
    rows = df.join(centre, keys)
    deviation = rows.withColumn("deviation", F.abs(F.col(value) - F.col("centre")))
    spread = exact_median(deviation, keys, "deviation", "mad")
    far = F.abs(F.col(value) - F.col("centre")) > n * F.col("mad")
    outlier = far & (F.col("mad") >= LEAST_DEVIATION)
    rows = rows.join(spread, keys).withColumn(value, F.when(~F.coalesce(outlier, F.lit(False)), F.col(value)))
    return rows.drop("centre", "mad")


def usable_recipes(event: DataFrame, special_steps: list[str], drop_pattern: str) -> DataFrame:
    """Rows with a recipe that does not match the pattern; special steps keep all rows."""
    normal = F.col("ppid").isNotNull() & ~F.col("ppid").rlike(drop_pattern)
    return event.where(F.col("step_desc").isin(special_steps) | F.coalesce(normal, F.lit(False)))


def wafer_matrix(event: DataFrame, value: str, steps: list[str], suffix: str = "") -> DataFrame:
    """One row per wafer, one column per step with the step's last value (nulls count)."""
    last = aggregates.last(F.col(value), [F.col(c) for c in ORDER])
    per_step = event.groupBy(*WAFER, "step_desc").agg(last.alias("v"))
    wide = per_step.groupBy(*WAFER).pivot("step_desc", steps).agg(F.first("v"))
    return wide.select(*WAFER, *[F.col(f"`{s}`").alias(f"{s}{suffix}") for s in steps])


def unpivot(matrix: DataFrame, steps: list[str], value: str) -> DataFrame:
    return matrix.unpivot(WAFER, steps, "step", value)


def mask_category(event: DataFrame, steps: list[str], categories: DataFrame) -> DataFrame:
    """MASK features by reticle category; reticles without a category give no row.

    The last reticle of each wafer and step is looked up as it is: a matrix that is unpivoted
    again would hold the same rows.
    """
    rows = event.where(clean("reticle_id").isNotNull() & F.col("step_desc").isin(steps))
    last = aggregates.last(F.col("reticle_id"), [F.col(c) for c in ORDER]).alias("reticle_id")
    found = rows.groupBy(*WAFER, "step_desc").agg(last).join(categories, "reticle_id")
    found = found.where(F.col("category").isNotNull())
    return found.select(*WAFER, F.concat(F.lit("MASK_"), "step_desc").alias("feature"), "category")
