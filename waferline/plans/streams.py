"""Queries that run their input through Structured Streaming, file by file, to the end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from waferline.operators import event as events
from waferline.operators import runs
from waferline.plans import bindings, rulebook
from waferline.plans.common import INLINE_EVENT
from waferline.plans.monitor import GATE_WALK
from waferline.plans.registry import query
from waferline.session import run_dir
from waferline.sources.schema import INLINE
from waferline.streaming import incremental

WAVES = 4

ALERTS = T.StructType([
    T.StructField("alert_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("unit", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("value", T.DoubleType()),
])


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("alert_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("unit"),
        F.col("event_type").alias("kind"), F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        "value",
    )


def run_in_waves(
    spark: SparkSession, sf_dir: str, transform: Callable[[DataFrame], DataFrame],
    start: Callable[[DataFrame, str], DataStreamWriter],
) -> str:
    """Let the events arrive in waves of time and run the stream over each; returns its folder.

    Each wave is one batch of as many files as Spark writes. The stream starts again from its
    checkpoint for the next one, so the watermark moves between waves.
    """
    base = run_dir(spark)
    rows = alerts(spark, sf_dir)
    first, last = rows.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    span = (last - first) // WAVES + 1
    wave = F.floor((F.unix_micros("ts") - first) / span)
    for i in range(WAVES):
        rows.where(wave == i).write.mode("append").parquet(f"{base}/in")
        stream = transform(incremental.read_files(spark, f"{base}/in", ALERTS))
        writer = start(stream, base).option("checkpointLocation", f"{base}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
    return base


def to_files(stream: DataFrame, base: str) -> DataStreamWriter:
    return stream.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")


def changed_rows(stream: DataFrame, base: str) -> DataStreamWriter:
    """The keys that a batch changed, each batch in a folder of its own, which a repeated batch overwrites."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    return stream.writeStream.outputMode("update").foreachBatch(save)


_LATEST = """SELECT user_id AS unit, event_type AS kind, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ts,
      arg_max(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, ts) AS status FROM events GROUP BY user_id, event_type"""


@query("stream_latest_status", _LATEST)
def stream_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_in_waves(spark, sf_dir, lambda s: incremental.latest_status(s, ["unit", "kind"]), changed_rows)
    changes = spark.read.parquet(f"{base}/out")
    last = runs.latest_status(changes, ["unit", "kind"], "batch", ["ts"])
    return last.select("unit", "kind", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "status")


@query("stream_alert_dedupe")
def stream_alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_in_waves(spark, sf_dir, lambda s: incremental.drop_repeats(s, ["unit", "kind"], "12 hours"), to_files)
    return spark.read.schema(ALERTS).parquet(f"{base}/out")


@query("stream_alert_rate", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type AS kind, count(*) AS n FROM events GROUP BY ALL""")
def stream_alert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour, the newest ones as far as they have come: a batch gives the hours that it changed."""
    base = run_in_waves(spark, sf_dir, lambda s: incremental.alert_rate(s, ["kind"]), changed_rows)
    rate = spark.read.schema("hour timestamp, kind string, n bigint, batch bigint").parquet(f"{base}/out")
    last = rate.groupBy("hour", "kind").agg(F.max_by("n", "batch").alias("n"))
    return last.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


@query("stream_alert_gate", f"{GATE_WALK} SELECT user_id AS unit, event_id AS alert_id, outcome FROM walk WHERE rn > 0")
def stream_alert_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    def gate(stream: DataFrame) -> DataFrame:
        loud = stream.where("value > 20").select("unit", "alert_id", "kind", F.unix_seconds("ts").alias("second"))
        return incremental.gate(loud, "unit", 2, 43_200)

    base = run_in_waves(spark, sf_dir, gate, to_files)
    return spark.read.schema("unit bigint, alert_id bigint, outcome string").parquet(f"{base}/out")


@query("stream_event_build", f"""WITH {INLINE_EVENT} SELECT root_lot_id, wafer_id, item_id, value, measure_pos, tkout_time,
      strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time, vehicle, substr(tkout_time, 1, 10) AS date, split FROM inline_event""")
def stream_event_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark)
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("date", F.substring("tkout_time", 1, 10))
    time = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time")
    raw = raw.select("root_lot_id", "wafer_id", "item_id", "value", "measure_pos", "tkout_time", time, "split", "vehicle", "date")
    raw.repartition(WAVES, "wafer_id").write.parquet(f"{base}/raw")
    stream = incremental.read_files(spark, f"{base}/raw", raw.schema, files_per_batch=1)
    items = bindings.rules(spark, "inline_rules")

    def build(rows: DataFrame) -> DataFrame:
        return events.build(rows, INLINE, rulebook.LOT_PREFIX, items, [], ["vehicle", "date"])

    run = incremental.rebuild_dates(
        stream, lambda: spark.read.schema(raw.schema).parquet(f"{base}/raw"), build, f"{base}/event", f"{base}/state"
    )
    run.awaitTermination()
    return spark.read.schema("root_lot_id string, wafer_id string, item_id string, value double, measure_pos string, tkout_time string, "
                             "time string, split string, vehicle string, date string").parquet(f"{base}/event")

