"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("waferline")
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="waferline-")
    context.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession) -> str:
    """A new folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, plain: Sequence[str] = ()) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    For results that are read more than once, or that must not change between two reads. The
    table outlives executors, and unlike a checkpoint it keeps columns apart and its size known.
    ``plain`` names columns whose values hardly repeat; no dictionary is tried for them.
    """
    path = run_dir(df.sparkSession)
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
