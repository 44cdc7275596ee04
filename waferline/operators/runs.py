"""Run logs, extraction plans, partition states and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.operators.ranking import running_total, top_rows

# Severity order, statuses that count as failures, delays between retries in seconds.
SEVERITIES = ("info", "warning", "critical")
FAILED = ("failed", "timeout_reshard", "upload_failed")
RETRY_DELAYS = (300, 900, 1800, 3600)
MAX_ATTEMPTS = 5
CRITICAL_AGE = 43_200


def parse_log(lines: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Records of a JSON-lines log; lines that do not parse are left out."""
    bad = "_bad"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = lines.withColumn("rec", F.from_json(column, wide, options))
    parsed = parsed.where(F.col("rec").isNotNull() & F.col(f"rec.{bad}").isNull())
    return parsed.select(*[c for c in lines.columns if c != column], *[f"rec.{f.name}" for f in schema.fields])


def severity(ok: str = "ok", error: str | None = None) -> Column:
    out = F.when(~F.col(ok), "warning").otherwise("info")
    return F.when(F.coalesce(F.col(error), F.lit("")) != "", "critical").otherwise(out) if error else out


def latest_status(log: DataFrame, keys: list[str], ts: str, columns: list[str]) -> DataFrame:
    """The last record per key that has a status."""
    rows = log.where(F.col("status").isNotNull())
    last = F.max(F.struct(ts, "status", *columns)).alias("row")
    return rows.groupBy(*keys).agg(last).select(*keys, "row.*")


def partition_status(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """State of a partition from the latest states of its chunks."""
    def count(status: str) -> Column:
        return F.sum((F.col("status") == status).cast("int"))

    sums = chunks.groupBy(*keys).agg(
        F.count("*").alias("total_chunks"), count("success").alias("done_chunks"),
        count("failed").alias("failed"), count("in_progress").alias("running"),
    )
    state = (
        F.when(F.col("done_chunks") == F.col("total_chunks"), "success")
        .when(F.col("failed") > 0, "partial_failed")
        .when(F.col("running") > 0, "running")
        .otherwise("planned")
    )
    return sums.select(*keys, "total_chunks", "done_chunks", state.alias("status"))


def completeness(chunks: DataFrame, keys: list[str], tolerance_pct: float) -> DataFrame:
    """Outcome of an extraction plan from chunk rows (status, expected_rows, actual_rows).

    All chunks fine and no rows is a success with an empty result; then a failed chunk; then a row
    count off by more than the tolerance.
    """
    sums = chunks.groupBy(*keys).agg(
        F.sum(F.when(F.col("status") == "success", F.col("actual_rows")).otherwise(0)).alias("actual"),
        F.coalesce(F.sum("expected_rows"), F.lit(0)).alias("expected"),
        F.count("*").alias("n"),
        F.sum((F.col("status") == "success").cast("int")).alias("fine"),
    )
    off = F.abs(F.col("actual") - F.col("expected")) / F.greatest("expected", F.lit(1))
    all_fine = F.col("fine") == F.col("n")
    outcome = (
        F.when((F.col("actual") == 0) & all_fine, "success_empty")
        .when((F.col("expected") > 0) & ~all_fine, "partial_failed")
        .when((F.col("expected") > 0) & (off > tolerance_pct / 100), "completeness_failed")
        .otherwise("success")
    )
    diff = F.when((F.col("expected") > 0) & (F.col("actual") != 0), F.round(off * 100, 3))
    return sums.select(*keys, "actual", "expected", diff.alias("diff_pct"), outcome.alias("outcome"))


def shard_plan(rows: DataFrame, keys: list[str], shard: str, target_rows: int) -> DataFrame:
    """Shards dealt evenly over ceil(rows / target) chunks, no more chunks than shards.

    The position of a shard comes from a distributed running count, not from one sorted task.
    """
    counts = rows.where(F.col(shard).isNotNull()).groupBy(*keys, shard).agg(F.count("*").alias("shard_rows"))
    total = counts.groupBy(*keys).agg(F.sum("shard_rows").alias("estimated_rows"))
    placed = running_total(counts.select(*keys, shard), keys, [shard], F.lit(1), "position").join(total, keys)
    chunks = F.least(F.ceil(F.col("estimated_rows") / target_rows), F.col("total"))
    placed = placed.withColumn("n_chunks", F.greatest(F.lit(1), chunks))
    return placed.select(
        *keys, shard, "n_chunks", F.pmod(F.col("position") - 1, F.col("n_chunks")).alias("chunk"),
        F.expr("estimated_rows div n_chunks").alias("expected_rows"),
    )


def run_summary(runs: DataFrame, recent: int) -> DataFrame:
    """Per vehicle, the last ``recent`` runs: counts, last state and mean seconds."""
    last = top_rows(runs, ["vehicle"], [F.col("ts").desc(), F.col("run_id").desc()], recent)
    newest = F.max(F.struct("ts", "run_id", "ok", "mode"))
    return last.groupBy("vehicle").agg(
        F.count("*").alias("runs"), F.sum(F.col("ok").cast("int")).alias("ok"),
        F.sum((~F.col("ok")).cast("int")).alias("failed"), newest["ok"].alias("last_ok"),
        newest["mode"].alias("last_mode"), F.round(F.avg("elapsed_sec"), 2).alias("avg_sec"),
    )


def log_tail(runs: DataFrame, limit: int, vehicle: str | None = None, mode: str | None = None,
             failed_only: bool = False, min_severity: str | None = None) -> DataFrame:
    """Newest records first, after the filters. ``runs`` has a severity column."""
    df = runs
    if vehicle:
        df = df.where(F.col("vehicle") == vehicle)
    if mode:
        df = df.where(F.col("mode") == mode)
    if failed_only:
        df = df.where(~F.col("ok"))
    if min_severity:
        df = df.where(F.col("severity").isin(*SEVERITIES[SEVERITIES.index(min_severity) :]))
    return df.orderBy(F.col("ts").desc(), F.col("run_id").desc()).limit(limit)


def retry_state(log: DataFrame, now: str | Column, delays: tuple[int, ...] = RETRY_DELAYS,
                max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Retry state of each unit with failures after its last success.

    ``log`` has unit, ts and status: failed, success, or resumed (an operator's resume that took
    effect, which starts a new round of attempts). Two group-bys, no walk through the records.
    """
    marks = log.groupBy("unit").agg(
        F.max(F.when(F.col("status") == "success", F.col("ts"))).alias("last_success"),
        F.max(F.when(F.col("status").isin("success", "resumed"), F.col("ts"))).alias("last_reset"),
    )
    rows = log.where(F.col("status").isin("failed", "resumed")).join(marks, "unit")
    rows = rows.where(F.col("last_success").isNull() | (F.col("ts") > F.col("last_success")))
    failed = F.col("status") == "failed"
    in_round = failed & (F.col("last_reset").isNull() | (F.col("ts") > F.col("last_reset")))
    state = rows.groupBy("unit").agg(
        F.sum(in_round.cast("int")).alias("attempts"),
        F.sum(failed.cast("int")).alias("total_attempts"),
        F.min(F.when(failed, F.col("ts"))).alias("first_failed"),
        F.max(F.when(failed, F.col("ts"))).alias("last_failed"),
        F.max("last_reset").alias("last_reset"),
    ).where("total_attempts > 0")
    delay = F.element_at(
        F.array(*[F.lit(d) for d in delays]), F.least(F.greatest(F.col("attempts").cast("int"), F.lit(1)), F.lit(len(delays)))
    )
    blocked = F.col("attempts") >= max_attempts
    next_retry = F.when(F.col("attempts") == 0, F.col("last_reset")).otherwise(
        F.timestamp_seconds(F.unix_seconds(F.col("last_failed").cast("timestamp")) + delay).cast("timestamp_ntz")
    )
    clock = now if isinstance(now, Column) else F.lit(now)
    age = F.unix_seconds(clock.cast("timestamp")) - F.unix_seconds(F.col("first_failed").cast("timestamp"))
    grave = blocked | (age >= CRITICAL_AGE) | (F.col("attempts") >= max_attempts)
    return state.select(
        "unit", F.when(blocked, "blocked").otherwise("retry_wait").alias("status"), "attempts",
        "total_attempts", F.when(~blocked, next_retry).alias("next_retry"), age.alias("age_sec"),
        F.when(grave, "critical").otherwise("warning").alias("severity"),
    )


def retry_summary(state: DataFrame, now: Column) -> DataFrame:
    """Totals over the units that wait for a retry or are blocked; due are those whose retry time has come."""
    blocked = F.col("status") == "blocked"
    return state.groupBy("severity").agg(
        F.count("*").alias("pending"), F.sum((~blocked).cast("int")).alias("waiting"),
        F.sum(blocked.cast("int")).alias("blocked"),
        F.sum(F.coalesce(~blocked & (F.col("next_retry") <= now), F.lit(False)).cast("int")).alias("due"), F.max("age_sec").alias("oldest_age_sec"),
        F.min("next_retry").alias("next_retry"), F.max("attempts").alias("max_attempts"),
    )


def anomalies(chunks: DataFrame, partitions: DataFrame, now: str | Column, limit: int | None = None) -> DataFrame:
    """Failed and stuck chunks, probe errors, and partly failed partitions, with a severity by age.

    The gravest come first, then the oldest; all of them, unless a limit is given.
    """
    clock = now if isinstance(now, Column) else F.lit(now)
    age = F.unix_seconds(clock.cast("timestamp")) - F.unix_seconds(F.col("ts").cast("timestamp"))
    aged = chunks.withColumn("age_sec", age)
    failed = F.col("status").isin(*FAILED)
    stuck = (F.col("status") == "in_progress") & (F.col("age_sec") > 1800)
    kind = F.when(failed, "chunk_failed").when(stuck, "stuck_in_progress")
    young = F.when(failed, F.col("age_sec") < 3600).otherwise(F.col("age_sec") > 3600)
    kind = F.coalesce(kind, F.when(F.col("status") == "probe_error", "probe_error"))
    level = F.when(F.col("status") == "probe_error", "medium").when(young, "high").otherwise("medium")
    rows = aged.select(
        F.col("chunk_id").alias("subject"), kind.alias("kind"), level.alias("severity"), "age_sec"
    ).where("kind is not null")
    partial = partitions.where(F.col("status") == "partial_failed").select(
        F.col("partition_id").alias("subject"), F.lit("partition_partial").alias("kind"),
        F.lit("medium").alias("severity"), F.lit(None).cast("bigint").alias("age_sec"),
    )
    found = rows.unionByName(partial)
    grade = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    found = found.orderBy(grade, F.coalesce("age_sec", F.lit(0)).desc(), "subject", "kind")
    return found if limit is None else found.limit(limit)
