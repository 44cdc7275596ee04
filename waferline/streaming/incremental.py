"""Streaming forms of the incremental parts. The batch operators define their results."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from waferline.session import cut_lineage
from waferline.sources.commits import CommitLog, replace_partitions


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream, with a declared schema.

    Files are taken by their age. ``files_per_batch`` bounds a batch; where files of one age cover
    different times, keep them in one batch, or rows of the later ones make the others late.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def rebuild_dates(
    raw_stream: DataFrame,
    all_raw: Callable[[], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
) -> StreamingQuery:
    """Rebuild every date that new raw rows touch, as a whole, and replace just those partitions.

    A late row thus changes its own date, and a date that yields no rows any more loses its folder. Dates of
    finished batches stand in a log beside the table: a batch that comes again is skipped, and one that was
    broken off is rebuilt to the same partitions. ``all_raw`` and ``build`` have a ``date`` column.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, f"{root}/_batches", ["date"])
        if not log.snapshot(with_removed=True).where(F.col("version") == str(batch_id)).isEmpty():
            return
        dates = cut_lineage(batch.select("date").where("date IS NOT NULL").distinct())
        rows = all_raw().join(dates, "date", "left_semi")
        built = cut_lineage(replace_partitions(build(rows), root, ["date"], dates))
        log.append(built.withColumns({"written": F.current_timestamp(), "version": F.lit(str(batch_id)), "removed": F.col("n_rows") == 0}))

    return (
        raw_stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest_status(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Last status per key, kept as one struct of state per key. Use update or complete mode."""
    last = F.max(F.struct("ts", "status")).alias("row")
    return stream.where("status IS NOT NULL").groupBy(*keys).agg(last).select(*keys, "row.ts", "row.status")


def drop_repeats(stream: DataFrame, keys: list[str], window: str) -> DataFrame:
    """The first alert of a key; repeats within the watermark are dropped.

    The window starts at the first alert seen, while the batch gate counts from the last alert
    sent; the two differ at the edges of a window.
    """
    return stream.withWatermark("ts", window).dropDuplicatesWithinWatermark(keys)


def alert_rate(stream: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Alerts per hour and key. In append mode an hour comes once the watermark has passed it, in update mode as it grows."""
    hours = stream.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), *keys)
    return hours.agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), *keys, "n")


# Scopes share the calls and the state of this many buckets: a call into Python costs more than a scope's few alerts.
GATE_BUCKETS = 1_024
GATE_STATE = "recent_scopes array<string>, recent array<bigint>, scopes array<string>, kinds array<string>, seconds array<bigint>"


def gate(stream: DataFrame, scope: str, max_per_hour: int, window_sec: int, buckets: int = GATE_BUCKETS) -> DataFrame:
    """The batch alert gate as a stream: hourly cap and repeat window, per scope.

    ``stream`` has the scope column, alert_id, kind and second, already above the severity floor.
    Scopes are dealt to buckets by hash. What is kept of a scope is bounded: the times sent in the last hour, and
    one time per kind still inside its window, both as of the scope's last alert.
    """

    def decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sent, emitted = defaultdict(list), defaultdict(dict)  # by scope: times sent, and the last time of each kind
        if state.exists:
            recent_scopes, recent, scopes, kinds, seconds = state.get
            for name, second in zip(recent_scopes, recent):
                sent[name].append(second)
            for name, kind, second in zip(scopes, kinds, seconds):
                emitted[name][kind] = second
        batch = pd.concat(list(frames)).sort_values(["second", "alert_id"])
        outcome, touched = [], {}
        for name, second, kind in zip(batch[scope].tolist(), batch["second"].tolist(), batch["kind"].tolist()):
            touched[name] = second
            recent = sent[name] = [t for t in sent[name] if second - t < 3600]
            if max_per_hour > 0 and len(recent) >= max_per_hour:
                outcome.append("rate_limit")
            elif second - emitted[name].get(kind, -window_sec) < window_sec:
                outcome.append("dedupe")
            else:
                emitted[name][kind] = second
                recent.append(second)
                outcome.append("sent")
        for name, last in touched.items():
            emitted[name] = {k: t for k, t in emitted[name].items() if last - t < window_sec}
        times = [(name, t) for name, found in sent.items() for t in found]
        marks = [(name, k, t) for name, found in emitted.items() for k, t in found.items()]
        state.update((*([row[i] for row in times] for i in range(2)), *([row[i] for row in marks] for i in range(3))))
        yield pd.DataFrame({scope: batch[scope].to_numpy(), "alert_id": batch["alert_id"].to_numpy(), "outcome": outcome})

    # a scope goes through Python as text: whole numbers with a null among them would turn into floats
    rows = stream.withColumn("_bucket", F.pmod(F.xxhash64(scope), F.lit(buckets))).withColumn(scope, F.col(scope).cast("string"))
    decided = rows.groupBy("_bucket").applyInPandasWithState(
        decide, f"{scope} string, alert_id bigint, outcome string", GATE_STATE, "append", GroupStateTimeout.NoTimeout
    )
    return decided.withColumn(scope, F.col(scope).cast(stream.schema[scope].dataType))
