"""Event rows: raw rows of the vehicle's lots, matched to its steps or items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.functions.text import clean
from waferline.sources.schema import Source


def join_steps(raw: DataFrame, steps: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose step is mapped. The map's description replaces the raw one."""
    return raw.withColumn("step_id", F.trim("step_id")).drop("step_desc").join(steps, keys)


def keep_items(raw: DataFrame, items: DataFrame, column: str) -> DataFrame:
    """Rows whose item is in the list."""
    return raw.join(items.select(F.col("item_id").alias(column)), column, "left_semi")


def build(
    raw: DataFrame,
    source: Source,
    prefix: str,
    match_table: DataFrame | None,
    keys: list[str],
    extra: list[str],
) -> DataFrame:
    """One lazy plan: lot prefix, match, then the configured columns in order.

    ``keys`` are the join keys of a step map; ``extra`` columns pass through after the others.
    """
    event = raw.where(F.col("root_lot_id").cast("string").startswith(prefix))
    if source.match == "step" and "step_id" in raw.columns:
        event = join_steps(event, match_table, keys)
    elif source.match == "item" and source.item_col in raw.columns:
        event = keep_items(event, match_table, source.item_col)
    have = set(event.columns)
    cols = [c for c in source.columns if c in have]
    if "split" in have and "split" not in extra:
        extra = [*extra, "split"]
    if source.name == "FAB":
        return event.select(*[F.col(c).cast("string").alias(c) for c in cols], *extra)
    return event.select(*cols, *extra)


def keyless_dates(raw: DataFrame, date: str) -> DataFrame:
    """Dates without a single lot id: they build no event and are reported."""
    filled = F.max(F.when(clean("root_lot_id").isNotNull(), 1).otherwise(0))
    return raw.groupBy(date).agg(filled.alias("filled")).where("filled = 0").select(date)
