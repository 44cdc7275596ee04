"""Date partitions: reading, writing, freshness, retention and fingerprints."""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.text import as_col
from waferline.sources.commits import Folder, read_partitioned
from waferline.sources.schema import Source

PARTITIONS = ["source", "vehicle", "date"]


def scan(spark: SparkSession, root: str, source: Source, vehicle: str | None = None,
         last_days: int | None = None, today: str | None = None) -> DataFrame:
    """Rows of one source, of one vehicle if named. Filters on partition columns prune folders.

    The schema is declared, so no file footers are merged and columns a day lacks read as null.
    """
    fields = [*source.schema.fields, *[T.StructField(c, T.StringType()) for c in ("split", "arrival", *PARTITIONS)]]
    df = read_partitioned(spark, root, T.StructType(fields))
    df = df.where(F.col("source") == source.name)
    if vehicle is not None:
        df = df.where(F.col("vehicle") == vehicle)
    if last_days is not None:
        day = F.lit(today).cast("date") if today else F.current_date()
        df = df.where(F.col("date") > F.date_sub(day, last_days).cast("string"))
    return df


def partition_date(time: str | Column, fallback: str) -> Column:
    """The date a row is stored under: the first ten characters of its time, else the fallback."""
    day = F.nullif(F.substring(as_col(time).cast("string"), 1, 10), F.lit(""))
    return F.coalesce(day, F.lit(fallback))


def write(df: DataFrame, root: str, source: Source, vehicle: str, fallback: str) -> bool:
    """Replace exactly the touched date partitions. An empty result writes nothing."""
    if df.isEmpty():
        return False
    time = source.partition_time()
    if time and time in df.columns:
        date = partition_date(time, fallback)
    else:
        date = F.lit(fallback)
    out = df.withColumn("source", F.lit(source.name)).withColumn("vehicle", F.lit(vehicle))
    overwrite_partitions(out.withColumn("date", date), root, PARTITIONS)
    return True


def overwrite_partitions(df: DataFrame, root: str, by: list[str]) -> None:
    # rebalance groups rows by target folder and splits large folders over several tasks
    (df.hint("rebalance", *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(root))


def empty_frame(spark: SparkSession, source: Source) -> DataFrame:
    """No rows, the configured columns and ``split``: the result of an empty extraction."""
    fields = [*source.schema.fields, T.StructField("split", T.StringType())]
    return spark.createDataFrame([], T.StructType(fields))


def expired(dates: DataFrame, keep_days: int, today: str) -> DataFrame:
    """Partitions older than the newest ``keep_days`` calendar days."""
    day = F.try_to_date("date", "yyyy-MM-dd")
    return dates.where(day < F.date_sub(F.lit(today).cast("date"), keep_days - 1))


def date_folders(spark: SparkSession, root: str) -> list[str]:
    """The ``date=`` folders below ``root``, at its top or below source and vehicle folders, as relative paths."""
    folder = Folder(spark, root)
    return [name for depth in range(len(PARTITIONS)) for name in folder.names("*=*/" * depth + "date=*")]


def delete_expired(spark: SparkSession, root: str, keep_days: int, today: str) -> list[str]:
    """Delete expired ``date=`` folders below ``root`` through the Hadoop file system. Returns their dates.

    Names that are no date stay, and so does everything if ``keep_days`` is not positive.
    """
    if keep_days <= 0:
        return []
    names = [(n, n.rpartition("date=")[2]) for n in date_folders(spark, root)]
    rows = spark.createDataFrame(names, "name string, date string")
    gone = expired(rows, keep_days, today).collect()  # a row per folder
    delete_folders(spark, root, [r["name"] for r in gone])
    return sorted({r["date"] for r in gone})


def delete_folders(spark: SparkSession, root: str, names: list[str]) -> None:
    """Delete the named folders directly below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        fs.delete(path(path(root), name), True)


def settings_version(settings: dict) -> str:
    """Version of everything that shapes an event table; a change makes all its dates stale."""
    text = json.dumps(settings, sort_keys=True, ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def files(spark: SparkSession, root: str) -> DataFrame:
    """(path, written, bytes, source, vehicle, date) of the Parquet files below ``root``; no file is opened.

    A source of binary files whose content nobody asks for is a listing. Partition values come from the
    folders' names, null where a layout lacks one; no folder gives no rows.
    """
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    except AnalysisException:
        return spark.createDataFrame([], "path string, written timestamp, bytes bigint, source string, vehicle string, date string")
    def value(key: str) -> Column:
        name = F.nullif(F.regexp_extract("path", f"/{key}=([^/]*)/", 1), F.lit(""))
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias(key)
    shown = listed.where(~F.col("path").rlike("/[_.][^/]*/"))
    return shown.select("path", F.col("modificationTime").alias("written"), F.col("length").alias("bytes"), *[value(k) for k in PARTITIONS])


def file_times(spark: SparkSession, root: str) -> DataFrame:
    """Newest file time of each partition, from the listing alone."""
    return files(spark, root).groupBy(*PARTITIONS).agg(F.max("written").alias("written"))


def stale_partitions(raw: DataFrame, event: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Raw partitions whose event is missing, older than the raw, or of another version.

    ``raw`` has (keys, written); ``event`` has (keys, written, version).
    """
    built = event.select(*keys, F.col("written").alias("built"), F.col("version"))
    reason = (
        F.when(F.col("built").isNull(), "missing")
        .when(F.col("version") != version, "version")
        .when(F.col("built") < F.col("written"), "newer raw")
    )
    return raw.join(built, keys, "left").withColumn("reason", reason).where("reason is not null")


def pending(raw: DataFrame, event: DataFrame, keys: list[str]) -> DataFrame:
    """Raw dates without an event per ``keys``. Both sides have (keys, date)."""
    built = event.select(*keys, "date", F.lit(1).alias("built")).distinct()
    joined = raw.select(*keys, "date").distinct().join(built, [*keys, "date"], "left")
    return joined.groupBy(*keys).agg(
        F.count("*").alias("n_raw"), F.count("built").alias("n_event"),
        (F.count("*") - F.count("built")).alias("n_pending"), F.max("date").alias("newest_raw"),
    )


def never_filled(df: DataFrame, keys: list[str], wanted: list[str]) -> DataFrame:
    """Wanted columns without a single value per group, the ones that did not arrive included."""
    have = set(df.columns)
    counts = [(F.count(c) if c in have else F.lit(0).cast("bigint")).alias(c) for c in wanted]
    return df.groupBy(*keys).agg(*counts).unpivot(keys, wanted, "column", "n").where("n = 0").drop("n")


def row_digest(cols: list[str]) -> Column:
    """A 60-bit number from a row's values, the same in any engine that has md5.

    Each value comes with its length, so no two rows have one text; null has its own mark.
    """
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")


def fingerprints(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Row count and an order-free content sum per partition, combined on the map side."""
    total = F.sum(row_digest(cols).cast("decimal(38,0)")).cast("string")
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), total.alias("content"))


def changed(now: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions whose fingerprint differs from the stored one, new ones included."""
    old = stored.select(*keys, F.col("n_rows").alias("old_rows"), F.col("content").alias("old_content"))
    same = F.col("n_rows").eqNullSafe(F.col("old_rows")) & F.col("content").eqNullSafe(F.col("old_content"))
    return now.join(old, keys, "left").where(~same).drop("old_rows", "old_content")


def storage_by_layer(spark: SparkSession, roots: dict[str, str], warn_bytes: int) -> DataFrame:
    """Bytes, files and dates per layer, source and vehicle, from the listing alone."""
    out = None
    for layer, root in roots.items():
        group = [F.lit(layer).alias("layer"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("source", "vehicle")]]
        sums = files(spark, root).groupBy(*group).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("files"), F.count_distinct("date").alias("dates"),
            F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        )
        sums = sums.withColumn("warn", F.col("bytes") > warn_bytes)
        out = sums if out is None else out.unionByName(sums)
    return out
