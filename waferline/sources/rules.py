"""Rule tables: CSV files or small in-memory tables, every column a string."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.text import clean

# A rule table read on the driver is configuration; a larger one is a mistake, not data.
MAX_DRIVER_RULES = 100_000


def read_csv(
    spark: SparkSession, path: str, columns: list[str], required: list[str] | None = None
) -> DataFrame | None:
    """A rule CSV with every column a string; no file, no rules.

    Absent columns are null, but a file without one of ``required`` is refused.
    """
    try:
        df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    except AnalysisException:
        return None
    have = set(df.columns)
    absent = [c for c in required or [] if c not in have]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)}")
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in columns]
    )


def table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A rule table from Python rows. Spark knows its size and so may broadcast it on its own."""
    if len(rows) > MAX_DRIVER_RULES:
        raise ValueError(f"{len(rows)} rules on the driver, at most {MAX_DRIVER_RULES}")
    ints = {c for i, c in enumerate(columns) if rows and all(isinstance(r[i], int) for r in rows)}
    types = [pa.int32() if c in ints else pa.string() for c in columns]
    arrays = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]
    schema = T.StructType(
        [T.StructField(c, T.IntegerType() if c in ints else T.StringType()) for c in columns]
    )
    return spark.createDataFrame(pa.table(arrays, names=columns), schema)


def on_driver(rules: DataFrame) -> list[dict]:
    """Rules as dicts on the driver. Refuses a table beyond configuration size."""
    rows = rules.limit(MAX_DRIVER_RULES + 1).collect()
    if len(rows) > MAX_DRIVER_RULES:
        raise ValueError(f"more than {MAX_DRIVER_RULES} rules; join them instead")
    return [r.asDict() for r in rows]


def conflicts(step_map: DataFrame, keys: list[str]) -> DataFrame:
    """Steps with more than one description: the number and the first ten, sorted."""
    from waferline.operators.ranking import first_texts

    pairs = step_map.withColumn("step_id", clean("step_id")).withColumn("step_desc", clean("step_desc"))
    pairs = pairs.select(*keys, "step_desc").where("step_id is not null and step_desc is not null").distinct()
    many = pairs.groupBy(*keys).agg(F.count("*").alias("n_descs")).where("n_descs > 1")
    return many.join(first_texts(pairs, keys, "step_desc", 10, "descs"), keys)


def unique_steps(step_map: DataFrame, keys: list[str]) -> DataFrame:
    """Trimmed step map with one description per key; of repeats the last row (by ``pos``) counts."""
    rows = step_map.withColumn("step_id", clean("step_id")).withColumn("step_desc", clean("step_desc"))
    rows = rows.where("step_id is not null and step_desc is not null")
    return rows.groupBy(*keys).agg(F.max_by("step_desc", "pos").alias("step_desc"))


def allowed_items(reformatter: DataFrame | None, configured: bool = True) -> DataFrame | None:
    """Distinct items of the REAL rows.

    None means no filter (no list configured). A configured but unreadable list gives no items,
    so that the source is skipped.
    """
    if not configured:
        return None
    if reformatter is None:
        raise ValueError("an item list is configured but not readable: skip the source")
    real = F.upper(F.trim(F.coalesce("CATEGORY", F.lit("")))) == "REAL"
    return reformatter.where(real).select(clean("ITEMID").alias("item_id")).where("item_id is not null").distinct()
