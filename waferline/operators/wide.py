"""The wide table: one row per wafer, its order of columns, publishing and sending."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.functions.text import file_name, wafer_number
from waferline.operators.features import has_value
from waferline.sources.partitions import delete_folders

WIDE_KEY = ["PRODUCT", "ROOT_LOT_ID", "WAFER_ID"]
NUMBER = re.compile(r"\d+(?:\.\d+)?")
#: Rows of a send group that go into its sample.
SAMPLE_ROWS = 100

# The order of column families, and the column prefixes of each send group.
FAMILIES = ("KNOB_", "FAB_", "MASK_", "INLINE_", "VM_")
SEND_GROUPS = {
    "KNOB": ("KNOB_",),
    "FAB": ("FAB_", "MASK_"),
    "VM": ("VM_",),
    "INLINE": ("INLINE_",),
}


def base_keys(long: DataFrame) -> DataFrame:
    """Distinct wafers over all features, with ids in their wide form."""
    return long.select(
        "vehicle", F.trim("root_lot_id").alias("ROOT_LOT_ID"), wafer_number("wafer_id").alias("WAFER_ID")
    ).distinct()


def _place(column: str) -> tuple[int, float]:
    """Where a column stands: its family's place, then the first number after the family's prefix."""
    family = next((i for i, prefix in enumerate(FAMILIES) if column.startswith(prefix)), None)
    if family is None:
        return len(FAMILIES), 0.0
    digits = NUMBER.search(column, len(FAMILIES[family]))
    return family, float(digits[0]) if digits else float("inf")


def ordered_columns(columns: list[str]) -> list[str]:
    """Families in their order, each by the first number in the name; others last. Ties stay as given."""
    return sorted(columns, key=_place)


def column_order_key(name: str | Column) -> list[Column]:
    """The same order over a table of names: family, first number, name."""
    col = F.col(name) if isinstance(name, str) else name
    family = F.lit(len(FAMILIES))
    rest = col
    for i, prefix in reversed(list(enumerate(FAMILIES))):
        family = F.when(col.startswith(prefix), i).otherwise(family)
        rest = F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 10_000)).otherwise(rest)
    number = F.nullif(F.regexp_extract(rest, r"\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")
    return [family, F.coalesce(number, F.lit(float("inf")))]


def pivot(long: DataFrame, text: list[str], numbers: list[str], products: DataFrame) -> DataFrame:
    """Long to wide with a known list of features, so that no extra pass finds the columns.

    ``products`` has vehicle and PRODUCT; a vehicle without one takes its own name. A wafer's cells are
    gathered as one map from feature to value, so the plan and the work of a row are the same for any
    number of features; the columns are then looked up in one projection. Rows are exchanged once, by wafer. Of
    several values of a cell the greatest counts.
    """
    key = ["vehicle", "ROOT_LOT_ID", "WAFER_ID"]
    keyed = long.select(
        "vehicle", F.trim("root_lot_id").alias("ROOT_LOT_ID"), wafer_number("wafer_id").alias("WAFER_ID"),
        "feature", "value_str", "value_num",
    )
    cells = keyed.repartition(*key).groupBy(*key, "feature").agg(F.max("value_str").alias("s"), F.max("value_num").alias("n"))
    entry = F.struct("feature", F.struct("s", "n"))
    wafers = cells.groupBy(*key).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
    wide = wafers.join(products, "vehicle", "left")
    product = F.coalesce("PRODUCT", "vehicle").alias("PRODUCT")
    kind = {**dict.fromkeys(text, "s"), **dict.fromkeys(numbers, "n")}
    columns = [F.try_element_at("cells", F.lit(c)).getField(kind[c]).alias(c) for c in ordered_columns([*text, *numbers])]
    return wide.select("vehicle", product, *WIDE_KEY[1:], *columns)


def filled_features(long: DataFrame) -> list[str]:
    """Names of features with at least one value: the columns a wide table keeps."""
    rows = long.where(has_value()).select("feature").distinct()
    return sorted(r["feature"] for r in rows.collect())  # one name per rule


def nonnull_counts(wide: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n): one pass over the table, then one row per column."""
    counts = wide.agg(*[F.count(f"`{c}`").alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n")


def check(wide: DataFrame, keys: list[str]) -> None:
    """Refuse an empty table, a null key and a repeated key."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    groups = wide.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("null_key", null_key)
    row = groups.agg(
        F.sum("n").alias("rows"), F.max("null_key").alias("null_key"), F.max("n").alias("most")
    ).first()
    if not row["rows"]:
        raise ValueError("the wide table has no rows")
    if row["null_key"]:
        raise ValueError("the wide table has a null key")
    if row["most"] > 1:
        raise ValueError("the wide table repeats a key")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with one key, the last by ``order``; combined on the map side."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("row")
    return df.groupBy(*keys).agg(last).select(*keys, *[f"row.`{c}`" for c in rest])


def publish(wide: DataFrame, root: str, previous: list[str] | None = None) -> list[str]:
    """One folder per product; a wafer in two vehicles keeps the later vehicle's row.

    Only the products present are replaced. Of the other folders below ``root``, those that
    ``previous`` names (the result of the run before) are removed and the rest stays.
    """
    latest = keep_last(wide, WIDE_KEY, ["vehicle"]).withColumn("product_name", file_name("PRODUCT"))
    (latest.sortWithinPartitions(*WIDE_KEY[1:]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("product_name").parquet(root))
    names = wide.select(file_name("PRODUCT").alias("name")).distinct()
    published = sorted(r["name"] for r in names.collect())  # a configured list of products
    delete_folders(wide.sparkSession, root, [f"product_name={p}" for p in set(previous or []) - set(published)])
    return published


def send_columns(columns: list[str], group: str) -> list[str]:
    """The columns of a send group in the order of the wide table."""
    return ordered_columns([c for c in columns if c.startswith(SEND_GROUPS[group])])


def send(wide: DataFrame, group: str) -> DataFrame | None:
    """The key and the columns of one group; None when it has no columns."""
    cols = send_columns(wide.columns, group)
    return wide.select(*WIDE_KEY, *[f"`{c}`" for c in cols]) if cols else None


def write_send(wide: DataFrame, root: str) -> dict[str, str]:
    """Each group as parquet and CSV, and its first rows by key as one CSV sample; groups without columns are skipped."""
    out = {}
    for group in SEND_GROUPS:
        part = send(wide, group)
        if part is None:
            out[group] = "skipped"
            continue
        part.write.mode("overwrite").parquet(f"{root}/{group}/parquet")
        part.write.mode("overwrite").option("header", True).csv(f"{root}/{group}/csv")
        head = part.orderBy(*WIDE_KEY).limit(SAMPLE_ROWS)
        head.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/{group}/sample")
        out[group] = "written"
    return out
