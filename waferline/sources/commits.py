"""A log of what has been built, and writes that take effect whole or not at all.

The log is a folder of numbered commits, each a small Parquet table that is written aside and then renamed,
so a reader sees a commit whole or not. Its snapshot is the newest entry of each key. A guarded write goes
to a hidden folder first; its rows are counted while they are written, and only a table that passes its
checks is moved into place. One writer at a time is assumed, as for the tables themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.session import cut_lineage

ENTRY = [T.StructField("written", T.TimestampType()), T.StructField("version", T.StringType()),
         T.StructField("n_rows", T.LongType()), T.StructField("removed", T.BooleanType())]


class Folder:
    """A folder of any file system that Spark reaches, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.at(name))

    def names(self, pattern: str = "*") -> list[str]:
        found = self.fs.globStatus(self.at(pattern)) if self.exists() else None
        return [s.getPath().toString()[len(self._root()) + 1 :] for s in found or []]

    def _root(self) -> str:
        return self.fs.makeQualified(self.at()).toString()

    def delete(self, name: str = "") -> None:
        self.fs.delete(self.at(name), True)

    def move(self, name: str, to: str) -> None:
        """Rename; what a rename can't replace must be gone before."""
        target = self.at(to)
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self.at(name), target):
            raise OSError(f"{self.path}: {name} could not be moved to {to}")


class CommitLog:
    """Entries (keys, written, version, n_rows, removed), of which the newest of each key counts."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.keys, self.folder = spark, keys, Folder(spark, path)
        self.schema = T.StructType([*[T.StructField(k, T.StringType()) for k in keys], *ENTRY])

    def snapshot(self, with_removed: bool = False) -> DataFrame:
        """The newest entry of each key; keys whose newest entry removes them are left out."""
        schema = T.StructType([*self.schema.fields, T.StructField("commit", T.LongType())])
        if not self.folder.names("commit=*"):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(schema).parquet(self.folder.path)
        newest = F.max(F.struct("commit", *[f.name for f in ENTRY])).alias("entry")
        found = rows.groupBy(*self.keys).agg(newest).select(*self.keys, *[f"entry.{f.name}" for f in ENTRY])
        return found if with_removed else found.where("NOT removed")

    def append(self, entries: DataFrame) -> int:
        """Add a commit, also an empty one. Returns its number."""
        number = 1 + max((int(n.split("=")[1]) for n in self.folder.names("commit=*")), default=0)
        staged = f"_staged-{uuid.uuid4().hex}"
        entries.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).coalesce(1).write.parquet(f"{self.folder.path}/{staged}")
        self.folder.move(staged, f"commit={number}")
        return number


class Refused(ValueError):
    """A table that did not pass the checks of its write; what was there before is still there."""


def _staged(df: DataFrame, folder: Folder, by: list[str], required: list[str], unique: list[str]) -> tuple[str, int]:
    """Write ``df`` to a hidden folder of ``folder`` and check it. Returns the folder's name and the rows."""
    staged = f"_staged-{uuid.uuid4().hex}"
    seen = Observation()
    nulls = F.sum(F.greatest(*[F.col(c).isNull().cast("int") for c in [*required, *required]]) if required else F.lit(0))
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), nulls.alias("nulls")).write
    (writer.partitionBy(*by) if by else writer).parquet(f"{folder.path}/{staged}")
    counts = seen.get
    reason = ""
    if counts["nulls"]:
        reason = f"{counts['nulls']} rows with a null in {', '.join(required)}"
    elif unique and counts["rows"]:
        # only the key columns of the staged table are read
        written = df.sparkSession.read.schema(df.schema).parquet(f"{folder.path}/{staged}")
        if not written.groupBy(*unique).count().where("count > 1").isEmpty():
            reason = f"repeated keys in {', '.join(unique)}"
    if reason:
        folder.delete(staged)
        raise Refused(f"{folder.path}: {reason}")
    return staged, counts["rows"]


def replace_table(df: DataFrame, path: str, required: Iterable[str] = (), unique: Iterable[str] = (), by: Iterable[str] = (), allow_empty: bool = False) -> int:
    """Replace the table at ``path`` if the new one has rows, no null in ``required`` and no repeated ``unique`` key.

    Otherwise ``Refused`` is raised and the former table stays. Returns the number of rows.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    folder = Folder(df.sparkSession, parent)
    staged, rows = _staged(df, folder, list(by), list(required), list(unique))
    if not rows and not allow_empty:
        folder.delete(staged)
        raise Refused(f"{path}: the table has no rows")
    former = f"_former-{uuid.uuid4().hex}"
    if folder.exists(name):
        folder.move(name, former)
    try:
        folder.move(staged, name)
    except Exception:
        if folder.exists(former):
            folder.move(former, name)
        raise
    folder.delete(former)
    return rows


def replace_partitions(df: DataFrame, path: str, by: list[str], expected: DataFrame, required: Iterable[str] = ()) -> DataFrame:
    """Replace exactly the ``expected`` partitions (rows of ``by``) of the table at ``path``.

    A partition of which ``df`` has no row loses its folder. Returns (by, n_rows), 0 for those. Work on the
    driver is a rename a partition, as in any commit of partitioned output.
    """
    spark, folder = df.sparkSession, Folder(df.sparkSession, path)
    staged, _ = _staged(df.hint("rebalance", *by), folder, by, list(required), [])
    made = set(Folder(spark, f"{path}/{staged}").names("/".join(f"{k}=*" for k in by)))
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    keys = [T.StructField(k, T.StringType()) for k in by]
    rows = T.StructType([*[f for f in df.schema.fields if f.name not in by], *keys])
    found = read_partitioned(spark, f"{path}/{staged}", rows) if made else spark.createDataFrame([], rows)
    # only partition values are asked for, so the count comes from the files' footers
    counts = cut_lineage(found.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")))
    wanted = {"/".join(escape(k, r[k]) for k in by) for r in expected.select(*by).distinct().toLocalIterator()}
    for name in sorted(wanted | made):
        folder.delete(name)
        if name in made:
            folder.move(f"{staged}/{name}", name)
    folder.delete(staged)
    return expected.select(*by).distinct().join(counts, by, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; without any rows written yet, an empty one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
