"""What to extract: windows, backfill grids and key batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.operators.ranking import running_total


def windows(units: DataFrame, today: str, span_days: str | Column, split_days: str | Column) -> DataFrame:
    """Half-open extraction windows of each unit over the days before ``today``.

    The last window is today itself, one day wide. ``units`` has one row per vehicle and source.
    """
    day = F.lit(today).cast("date")
    span = F.col(span_days) if isinstance(span_days, str) else span_days
    split = F.col(split_days) if isinstance(split_days, str) else split_days
    offsets = F.sequence(F.lit(0), F.greatest(span - 1, F.lit(0)), split)
    starts = F.transform(F.when(span > 0, offsets).otherwise(F.array().cast("array<int>")), lambda i: i - span)
    rows = units.withColumn("start", F.explode(F.concat(starts, F.array(F.lit(0)))))
    end = F.when(F.col("start") < 0, F.least(F.col("start") + split, F.lit(0))).otherwise(1)
    return rows.withColumn("end", F.date_add(day, end)).withColumn("start", F.date_add(day, F.col("start")))


def backfill(units: DataFrame, today: str, default_days: int) -> DataFrame:
    """Product, source and each of the last N+1 days; a product may override N.

    ``units`` has product, source, priority and override_days. Newest date first, then priority.
    """
    days = F.coalesce(F.nullif("override_days", F.lit(0)), F.lit(default_days))
    back = F.explode(F.sequence(F.lit(0), days))
    rows = units.select("product", "source", "priority", back.alias("back"))
    return rows.select("product", "source", "priority", F.date_sub(F.lit(today).cast("date"), F.col("back")).alias("date"))


def backfill_order() -> list[Column]:
    return [F.col("date").desc(), F.col("priority"), F.col("product"), F.col("source")]


def rows_of_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the probed, non-blank ones. No keys, no rows."""
    probed = keys.select(key).where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "").distinct()
    return table.join(probed, key, "left_semi")


def key_batches(keys: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """Batches of ``size`` distinct keys, numbered from 0: the unit of an extraction by IN lists."""
    probed = keys.select(group, key).where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "").distinct()
    placed = running_total(probed, [group], [key], F.lit(1), "position").drop("total")
    return placed.withColumn("batch", F.expr(f"(position - 1) div {size}")).drop("position")
