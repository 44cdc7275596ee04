"""Queries over logs, health, alerts and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.operators import alerts, quality, runs, wide
from waferline.operators.ranking import nearest_ranks
from waferline.plans import bindings, common, rulebook
from waferline.plans.common import FAB_EVENT, LONG
from waferline.plans.registry import query
from waferline.session import cut_lineage
from waferline.sources import rules as rule_tables
from waferline.sources.schema import FAB, missing_columns

NOW = "2024-01-31 00:00:00"
TODAY = "2024-01-31"


def _clock():
    return F.lit(NOW).cast("timestamp_ntz")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.bound(spark, sf_dir, "log")


_LOG = "WITH " + bindings.cte("log")
_CHUNKS = "chunks AS (SELECT vehicle, date, max(ts) AS ts, arg_max(status, ts) AS status, arg_max(run_id, ts) AS run_id FROM log WHERE status IS NOT NULL GROUP BY vehicle, date)"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest state of each chunk, a vehicle's day."""
    return runs.latest_status(log(spark, sf_dir), ["vehicle", "date"], "ts", ["run_id"])


@query("latest_status", f"{_LOG}, {_CHUNKS} SELECT vehicle, date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, status, run_id FROM chunks")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks(spark, sf_dir).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_PARTITIONS = """partitions AS (SELECT date, count(*) AS total_chunks, count(*) FILTER (WHERE status = 'success') AS done_chunks,
      CASE WHEN count(*) FILTER (WHERE status = 'success') = count(*) THEN 'success' WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'partial_failed'
        WHEN count(*) FILTER (WHERE status = 'in_progress') > 0 THEN 'running' ELSE 'planned' END AS status FROM chunks GROUP BY date)"""


@query("partition_status", f"{_LOG}, {_CHUNKS}, {_PARTITIONS} SELECT * FROM partitions")
def partition_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.partition_status(chunks(spark, sf_dir), ["date"])


@query("status_counts", f"{_LOG}, {_CHUNKS} SELECT status, count(*) AS n FROM chunks GROUP BY status")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


_PLAN = """CASE WHEN cast(substr(vehicle, 2) AS bigint) % 9 = 4 THEN 'success' WHEN status = 'failed' AND date < '2024-01-04' THEN 'failed' ELSE 'success' END"""


@query("completeness", f"""{_LOG}, parts AS (SELECT vehicle, date, {_PLAN} AS status, 2 AS expected_rows,
        CASE WHEN cast(substr(vehicle, 2) AS bigint) % 9 = 4 THEN 0 ELSE n END AS actual_rows
      FROM (SELECT vehicle, date, count(*) AS n, coalesce(max(status) FILTER (WHERE status = 'failed'), 'success') AS status FROM log GROUP BY vehicle, date)),
    sums AS (SELECT vehicle, cast(sum(CASE WHEN status = 'success' THEN actual_rows ELSE 0 END) AS bigint) AS actual, cast(sum(expected_rows) AS bigint) AS expected,
      bool_and(status = 'success') AS fine FROM parts GROUP BY vehicle)
    SELECT vehicle, actual, expected, CASE WHEN actual <> 0 THEN round(abs(actual - expected) / expected * 100, 3) END AS diff_pct,
      CASE WHEN actual = 0 AND fine THEN 'success_empty' WHEN NOT fine THEN 'partial_failed' WHEN abs(actual - expected) / expected > 0.2 THEN 'completeness_failed' ELSE 'success' END AS outcome
    FROM sums""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = log(spark, sf_dir).groupBy("vehicle", "date").agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.when(F.col("status") == "failed", "failed")), F.lit("success")).alias("status")
    )
    parts = parts.selectExpr(
        "vehicle", "date", f"{_PLAN} AS status", "2 AS expected_rows",
        "CASE WHEN cast(substr(vehicle, 2) AS bigint) % 9 = 4 THEN 0 ELSE n END AS actual_rows",
    )
    return runs.completeness(parts, ["vehicle"], 20)


@query("run_percentiles", f"""{_LOG}, ranked AS (SELECT mode, elapsed_sec, row_number() OVER (PARTITION BY mode ORDER BY elapsed_sec) - 1 AS position,
        count(*) OVER (PARTITION BY mode) AS n FROM log)
    SELECT mode, max(elapsed_sec) FILTER (WHERE position = round_even(0.5 * (n - 1), 0)) AS p50,
      max(elapsed_sec) FILTER (WHERE position = round_even(0.95 * (n - 1), 0)) AS p95, max(elapsed_sec) AS p_max FROM ranked GROUP BY mode""")
def run_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_ranks(log(spark, sf_dir), ["mode"], "elapsed_sec", {"p50": 0.5, "p95": 0.95, "p_max": 1.0})


@query("run_summary", f"""{_LOG}, recent AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY vehicle ORDER BY ts DESC) <= 20)
    SELECT vehicle, count(*) AS runs, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS failed,
      arg_max(ok, ts) AS last_ok, arg_max(mode, ts) AS last_mode, round(avg(elapsed_sec), 2) AS avg_sec FROM recent GROUP BY vehicle""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_summary(log(spark, sf_dir), 20)


@query("last_started", f"{_LOG} SELECT vehicle, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_started FROM log GROUP BY vehicle")
def last_started(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = log(spark, sf_dir).groupBy("vehicle").agg(F.max("ts").alias("ts"))
    return newest.select("vehicle", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_started"))


_SEVERITY = "CASE WHEN elapsed_sec > 200 THEN 'critical' WHEN NOT ok THEN 'warning' ELSE 'info' END"


@query("log_tail", f"""{_LOG} SELECT run_id, vehicle, mode, ok, {_SEVERITY} AS severity FROM log
    WHERE mode = 'auto' AND {_SEVERITY} IN ('warning', 'critical') ORDER BY ts DESC, run_id DESC LIMIT 100""")
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("elapsed_sec") > 200, "slow")
    records = log(spark, sf_dir).withColumn("error", error)
    records = records.withColumn("severity", runs.severity("ok", "error"))
    tail = runs.log_tail(records, 100, mode="auto", min_severity="warning")
    return tail.select("run_id", "vehicle", "mode", "ok", "severity")


_RETRY = f"""marks AS (SELECT *, max(CASE WHEN status = 'success' THEN ts END) OVER unit AS last_success,
        max(CASE WHEN status IN ('success', 'resumed') THEN ts END) OVER unit AS last_reset FROM log WINDOW unit AS (PARTITION BY vehicle)),
    open_rows AS (SELECT * FROM marks WHERE status IN ('failed', 'resumed') AND (last_success IS NULL OR ts > last_success)),
    state AS (SELECT vehicle AS unit, count(*) FILTER (WHERE status = 'failed' AND (last_reset IS NULL OR ts > last_reset)) AS attempts,
      count(*) FILTER (WHERE status = 'failed') AS total_attempts, min(ts) FILTER (WHERE status = 'failed') AS first_failed,
      max(ts) FILTER (WHERE status = 'failed') AS last_failed, max(last_reset) AS last_reset FROM open_rows GROUP BY vehicle),
    retries AS (SELECT unit, CASE WHEN attempts >= 5 THEN 'blocked' ELSE 'retry_wait' END AS status, attempts, total_attempts,
      CASE WHEN attempts < 5 THEN floor(epoch(CASE WHEN attempts = 0 THEN last_reset ELSE date_trunc('second', last_failed) + INTERVAL 1 SECOND * [300, 900, 1800, 3600][least(attempts, 4)] END))::bigint END AS next_retry,
      epoch(TIMESTAMP '{NOW}')::bigint - floor(epoch(first_failed))::bigint AS age_sec,
      CASE WHEN attempts >= 5 OR epoch(TIMESTAMP '{NOW}')::bigint - floor(epoch(first_failed))::bigint >= 43200 THEN 'critical' ELSE 'warning' END AS severity
    FROM state WHERE total_attempts > 0)"""


@query("retry_state", f"{_LOG}, {_RETRY} SELECT * FROM retries")
def retry_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = log(spark, sf_dir).select(F.col("vehicle").alias("unit"), "ts", "status")
    state = runs.retry_state(records, _clock())
    return state.withColumn("next_retry", F.unix_seconds(F.col("next_retry").cast("timestamp")))


@query("retry_summary", f"""{_LOG}, {_RETRY} SELECT severity, count(*) AS pending, count(*) FILTER (WHERE status <> 'blocked') AS waiting,
      count(*) FILTER (WHERE status = 'blocked') AS blocked,
      count(*) FILTER (WHERE status <> 'blocked' AND next_retry <= epoch(TIMESTAMP '{NOW}')::bigint) AS due, max(age_sec) AS oldest_age_sec, min(next_retry) AS next_retry, max(attempts) AS max_attempts
    FROM retries GROUP BY severity""")
def retry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.retry_summary(retry_state(spark, sf_dir), F.unix_seconds(_clock().cast("timestamp")))


_AGE = f"epoch(TIMESTAMP '{NOW}')::bigint - floor(epoch(ts))::bigint"


@query("anomalies", f"""{_LOG}, {_CHUNKS}, {_PARTITIONS}, aged AS (SELECT concat(vehicle, '/', date) AS subject, status, {_AGE} AS age_sec FROM chunks)
    SELECT subject, 'chunk_failed' AS kind, CASE WHEN age_sec < 3600 THEN 'high' ELSE 'medium' END AS severity, age_sec FROM aged WHERE status = 'failed'
    UNION ALL SELECT subject, 'stuck_in_progress', CASE WHEN age_sec > 3600 THEN 'high' ELSE 'medium' END, age_sec FROM aged WHERE status = 'in_progress' AND age_sec > 1800
    UNION ALL SELECT subject, 'probe_error', 'medium', age_sec FROM aged WHERE status = 'resumed'
    UNION ALL SELECT date, 'partition_partial', 'medium', NULL FROM partitions WHERE status = 'partial_failed'
    ORDER BY CASE severity WHEN 'high' THEN 0 ELSE 1 END, coalesce(age_sec, 0) DESC, subject, kind""")
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = chunks(spark, sf_dir)
    parts = runs.partition_status(states, ["date"]).withColumnRenamed("date", "partition_id")
    states = states.withColumn("chunk_id", F.concat_ws("/", "vehicle", "date"))
    states = states.withColumn("status", F.when(F.col("status") == "resumed", "probe_error").otherwise(F.col("status")))
    return runs.anomalies(states, parts, _clock())


# ── stage health and alerts ──

_STAGE_TESTS = {"raw": "> 0", "event": "> 60", "feature": "> 150", "wide": "> 160", "publish": "> 230", "send": "> 300"}
_LATE = ("wide", "publish", "send")
# one pass over the events: the newest row of each stage is a conditional maximum
_STAGES = f"""WITH {bindings.cte('inline_raw')}, newest AS (SELECT vehicle, item_id AS source,
      {', '.join(f"max(time) FILTER (WHERE value {t}) AS {s}_built, max(substr(tkout_time, 1, 10)) FILTER (WHERE value {t}) AS {s}_date" for s, t in _STAGE_TESTS.items())}
      FROM inline_raw GROUP BY ALL),
    stages AS ({' UNION ALL '.join(f"SELECT vehicle, source, '{s}' AS stage, {'NULL' if s in _LATE else s + '_date'} AS latest_date, {s}_built AS built FROM newest" for s in _STAGE_TESTS)})"""
_HEALTH = f"""built AS (SELECT vehicle, stage, max(built) AS built FROM stages GROUP BY ALL),
    lagged AS (SELECT s.vehicle, s.source, s.stage, s.latest_date, (epoch(TIMESTAMP '{NOW}')::bigint - floor(epoch(s.built))::bigint) // 3600 AS age_hours,
        date_diff('day', cast(s.latest_date AS date), DATE '{TODAY}') AS lag_days,
        CASE WHEN s.stage IN ('wide', 'publish', 'send') THEN b.stage WHEN s.latest_date IS NOT NULL AND u.latest_date IS NOT NULL THEN u.stage END AS behind_of,
        CASE WHEN s.stage IN ('wide', 'publish', 'send') THEN (floor(epoch(b.built))::bigint - floor(epoch(s.built))::bigint) // 86400
          ELSE date_diff('day', cast(s.latest_date AS date), cast(u.latest_date AS date)) END AS late,
        CASE WHEN s.stage IN ('wide', 'publish', 'send') THEN s.built IS NULL ELSE s.latest_date IS NULL END AS missing
      FROM stages s
      LEFT JOIN stages u ON s.vehicle = u.vehicle AND s.source = u.source AND u.stage = CASE s.stage WHEN 'event' THEN 'raw' WHEN 'feature' THEN 'event' END
      LEFT JOIN built b ON s.vehicle = b.vehicle AND b.stage = CASE s.stage WHEN 'wide' THEN 'feature' WHEN 'publish' THEN 'wide' WHEN 'send' THEN 'wide' END),
    health AS (SELECT * EXCLUDE (late), CASE WHEN NOT missing AND behind_of IS NOT NULL THEN greatest(late, 0) END AS behind_days FROM lagged),
    reasons AS (SELECT *, CASE WHEN missing THEN 'missing' ELSE concat_ws('; ', CASE WHEN lag_days > 1 THEN concat('lag ', lag_days) END,
        CASE WHEN behind_days > 1 THEN concat('behind ', behind_of, ' ', behind_days) END,
        CASE WHEN stage IN ('feature', 'wide', 'publish', 'send') AND age_hours > 24 THEN 'old' END) END AS reason FROM health),
    judged AS (SELECT *, reason <> '' AS stalled, reason <> '' AND NOT (missing OR coalesce(behind_days > 1, false) OR behind_of IS NULL) AS cascade FROM reasons)"""


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw")
    day = F.substring("tkout_time", 1, 10)
    stages = [(s, F.col("value") > float(t[2:])) for s, t in _STAGE_TESTS.items()]
    newest = raw.groupBy("vehicle", F.col("item_id").alias("source")).agg(*[
        F.struct(F.lit(s).alias("stage"), (F.lit(None).cast("string") if s in _LATE else F.max(F.when(test, day))).alias("latest_date"), F.max(F.when(test, F.col("time"))).alias("built")).alias(s)
        for s, test in stages
    ])
    rows = newest.select("vehicle", "source", F.inline(F.array(*[F.col(s) for s, _ in stages])))
    return alerts.stage_health(rows, TODAY, _clock(), 1, ["feature", "wide", "publish", "send"])


@query("stage_health", f"{_STAGES}, {_HEALTH} SELECT * FROM judged")
def stage_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health(spark, sf_dir)


_STALLS = """stalls AS (SELECT concat_ws('|', 'stall', CASE WHEN stage = 'send' THEN '-' ELSE vehicle END, stage, source) AS id, 'stage_stall' AS type, vehicle, stage, source, reason
      FROM judged WHERE stalled AND NOT cascade)"""


@query("stall_alerts", f"{_STAGES}, {_HEALTH}, {_STALLS} SELECT * FROM stalls")
def stall_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.stall_alerts(health(spark, sf_dir), ["send"])


# snapshots of step alerts with an acknowledgement, from two ranges of splits
_SNAPSHOT = """SELECT concat_ws('|', 'um', vehicle, step_id, coalesce(eqp_id, '')) AS id, 'unmatched_step' AS type, vehicle, count(*) AS n_rows,
      CASE WHEN count(*) % 3 = 0 THEN '미확인예정' WHEN count(*) % 7 = 0 THEN '반영불필요' ELSE 'active' END AS status, '' AS reason
    FROM fab_raw WHERE (vehicle, step_id) NOT IN (SELECT (vehicle, step_id) FROM step_map) AND {test} GROUP BY vehicle, step_id, coalesce(eqp_id, '')"""
_NOW_TEST, _BEFORE_TEST = "split >= 'Y1997' AND coalesce(eqp_id, '') <> 'EQP_03'", "split < 'Y2000' AND coalesce(eqp_id, '') <> 'EQP_05'"
_FAB = "WITH " + bindings.cte("fab_raw", "step_map")
_SNAPSHOTS = f"{_FAB}, now_alerts AS ({_SNAPSHOT.format(test=_NOW_TEST)}), before_alerts AS ({_SNAPSHOT.format(test=_BEFORE_TEST)})"


def snapshot(spark: SparkSession, sf_dir: str, test: str) -> DataFrame:
    steps = bindings.rules(spark, "step_map").select("vehicle", "step_id").distinct()
    rows = bindings.bound(spark, sf_dir, "fab_raw").join(steps, ["vehicle", "step_id"], "left_anti").where(test)
    rows = rows.withColumn("eqp_id", F.coalesce("eqp_id", F.lit("")))
    counts = rows.groupBy("vehicle", "step_id", "eqp_id").agg(F.count("*").alias("n_rows"))
    hidden = F.when(F.col("n_rows") % 3 == 0, alerts.HIDDEN[0]).when(F.col("n_rows") % 7 == 0, alerts.HIDDEN[1])
    return counts.select(
        F.concat_ws("|", F.lit("um"), "vehicle", "step_id", "eqp_id").alias("id"), F.lit("unmatched_step").alias("type"),
        "vehicle", "n_rows", F.coalesce(hidden, F.lit("active")).alias("status"), F.lit("").alias("reason"),
    )


@query("alert_list", f"""{_SNAPSHOTS}, both_alerts AS (SELECT id, type, vehicle, n_rows, reason FROM now_alerts UNION ALL SELECT id, type, 'ZZ', n_rows, reason FROM before_alerts),
    acks AS (SELECT id, status, concat('seen ', n_rows) AS note FROM before_alerts WHERE status <> 'active')
    SELECT b.*, coalesce(a.status, 'active') AS status, coalesce(note, '') AS note FROM both_alerts b LEFT JOIN acks a USING (id)
    QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY vehicle) = 1""")
def alert_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = snapshot(spark, sf_dir, _BEFORE_TEST)
    rows = snapshot(spark, sf_dir, _NOW_TEST).unionByName(before.withColumn("vehicle", F.lit("ZZ"))).drop("status")
    note = F.concat(F.lit("seen "), F.col("n_rows").cast("string")).alias("note")
    acks = before.where("status <> 'active'").select("id", "status", note)
    return alerts.with_status(rows, acks).orderBy(*alerts.active_first())


_SHOWN = "status NOT IN ('미확인예정', '반영불필요')"


@query("alert_delta", f"""{_SNAPSHOTS} SELECT id, 'new' AS change FROM (SELECT id FROM now_alerts WHERE {_SHOWN} EXCEPT SELECT id FROM before_alerts WHERE {_SHOWN})
    UNION ALL SELECT id, 'resolved' FROM (SELECT id FROM before_alerts WHERE {_SHOWN} EXCEPT SELECT id FROM now_alerts WHERE {_SHOWN})""")
def alert_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.delta(snapshot(spark, sf_dir, _NOW_TEST), snapshot(spark, sf_dir, _BEFORE_TEST))


@query("alert_first_seen", f"""{_SNAPSHOTS} SELECT n.id, n.status, CASE WHEN b.id IS NULL THEN '{NOW}' ELSE concat('run ', b.n_rows) END AS first_seen FROM now_alerts n LEFT JOIN before_alerts b USING (id)""")
def alert_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.concat(F.lit("run "), F.col("n_rows").cast("string"))
    before = snapshot(spark, sf_dir, _BEFORE_TEST).withColumn("first_seen", seen)
    now = snapshot(spark, sf_dir, _NOW_TEST).select("id", "status")
    return alerts.first_seen(now, before, F.lit(NOW))


@query("alert_fingerprint", f"""{_SNAPSHOTS} SELECT vehicle, count(*) AS n,
      cast(sum(cast('0x' || substr(md5(concat_ws('|', length(id) || ':' || id, length(status) || ':' || status, '0:')), 1, 15) AS bigint)) AS varchar) AS fingerprint FROM now_alerts GROUP BY vehicle""")
def alert_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_fingerprint(snapshot(spark, sf_dir, _NOW_TEST))


# the rule walked row by row: the times sent in the last hour, and the last time of each kind
GATE_WALK = """WITH RECURSIVE loud AS (SELECT user_id, event_id, event_type AS kind, floor(epoch(ts))::bigint AS second,
        row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS rn FROM events WHERE value > 20),
    walk AS (SELECT DISTINCT user_id, 0::bigint AS rn, -1::bigint AS event_id, []::bigint[] AS recent, MAP {'': 0::bigint} AS emitted, '' AS outcome FROM loud
      UNION ALL SELECT user_id, rn, event_id, CASE WHEN passes THEN list_append(kept, second) ELSE kept END,
        CASE WHEN passes THEN map_concat(emitted, MAP {kind: second}) ELSE emitted END,
        CASE WHEN passes THEN 'sent' WHEN len(kept) >= 2 THEN 'rate_limit' ELSE 'dedupe' END
      FROM (SELECT *, len(kept) < 2 AND second - coalesce(map_extract(emitted, kind)[1], second - 43200) >= 43200 AS passes
        FROM (SELECT w.user_id, l.rn, l.event_id, l.kind, l.second, w.emitted, list_filter(w.recent, lambda t: l.second - t < 3600) AS kept
          FROM walk w JOIN loud l ON l.user_id = w.user_id AND l.rn = w.rn + 1)))"""


@query("alert_gate", f"""{GATE_WALK} SELECT e.user_id, e.event_id AS alert_id, e.event_type AS kind,
      coalesce(w.outcome, 'severity') AS outcome FROM events e LEFT JOIN walk w ON w.event_id = e.event_id""")
def alert_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = bindings.table(spark, sf_dir, "events")
    level = F.when(F.col("value") > 100, "critical").when(F.col("value") > 20, "warning").otherwise("info")
    rows = events.select(
        "user_id", F.col("event_id").alias("alert_id"), F.col("event_type").alias("kind"), level.alias("severity"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("second"),
    )
    return alerts.gate(rows, "user_id", "warning", 2, 43_200).select("user_id", "alert_id", "kind", "outcome")


# ── data quality ──

_RAW_CHECKS = """raw_sums AS (SELECT vehicle, count(*) AS n_rows, count(*) FILTER (WHERE substr(tkout_time, 1, 10) <> substr(day, 1, 10)) AS n_foreign,
      count(*) FILTER (WHERE lot IS NULL) AS null_lots, count(*) FILTER (WHERE wafer_id IS NULL) AS null_wafers
      FROM (SELECT *, concat(substr(split, 2), substr(tkout_time, 5, 6)) AS day, CASE WHEN split = 'Y1999' THEN NULL ELSE root_lot_id END AS lot FROM fab_raw) GROUP BY vehicle),
    raw_checks AS (SELECT vehicle, 'raw' AS stage, 'rows' AS name, n_rows::double AS n, CASE WHEN n_rows > 0 THEN 'ok' ELSE 'fail' END AS status FROM raw_sums
      UNION ALL SELECT vehicle, 'raw', 'missing_columns', 1, 'warn' FROM raw_sums
      UNION ALL SELECT vehicle, 'raw', 'foreign_dates', n_foreign, CASE WHEN n_foreign = 0 THEN 'ok' ELSE 'warn' END FROM raw_sums
      UNION ALL SELECT vehicle, 'raw', 'null_lots', null_lots, CASE WHEN null_lots = 0 THEN 'ok' ELSE 'warn' END FROM raw_sums
      UNION ALL SELECT vehicle, 'raw', 'null_wafers', null_wafers, CASE WHEN null_wafers = 0 THEN 'ok' ELSE 'warn' END FROM raw_sums)"""


def raw_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw").drop("part_id")
    absent = missing_columns(raw, FAB.columns)
    day = F.concat(F.substring("split", 2, 4), F.substring("tkout_time", 5, 6))
    lot = F.when(F.col("split") != "Y1999", F.col("root_lot_id"))
    raw = raw.withColumn("day", day).withColumn("root_lot_id", lot)
    return quality.raw_checks(raw, ["vehicle"], "tkout_time", "day", absent)


@query("dq_raw", f"WITH {bindings.cte('fab_raw')}, {_RAW_CHECKS} SELECT * FROM raw_checks")
def dq_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_checks(spark, sf_dir)


_EVENT_CHECKS = """hits AS (SELECT vehicle, round(avg(CASE WHEN starts_with(root_lot_id, 'R') THEN 1.0 ELSE 0.0 END) * 100, 6) AS prefix_pct FROM fab_raw GROUP BY vehicle),
    shares AS (SELECT r.vehicle, round(count(s.step_id) / count(*) * 100, 6) AS match_pct FROM (SELECT DISTINCT vehicle, step_id FROM fab_raw) r
      LEFT JOIN step_map s ON r.vehicle = s.vehicle AND r.step_id = s.step_id GROUP BY r.vehicle),
    event_sums AS (SELECT vehicle, count(*) AS n_rows, count(*) FILTER (WHERE trim(coalesce(step_desc, '')) = '') AS blank_descs FROM event GROUP BY vehicle),
    event_checks AS (SELECT vehicle, 'event' AS stage, 'prefix_pct' AS name, prefix_pct::double AS n, CASE WHEN prefix_pct > 0 THEN 'ok' ELSE 'fail' END AS status FROM hits
      UNION ALL SELECT vehicle, 'event', 'match_pct', match_pct, CASE WHEN match_pct >= 80 THEN 'ok' WHEN match_pct > 0 THEN 'warn' ELSE 'fail' END FROM shares
      UNION ALL SELECT vehicle, 'event', 'event_rows', n_rows, CASE WHEN n_rows > 0 THEN 'ok' ELSE 'fail' END FROM event_sums
      UNION ALL SELECT vehicle, 'event', 'blank_descs', blank_descs, CASE WHEN blank_descs = 0 THEN 'ok' WHEN blank_descs < n_rows THEN 'warn' ELSE 'fail' END FROM event_sums)"""


def event_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, event = bindings.bound(spark, sf_dir, "fab_raw"), common.fab_event(spark, sf_dir)
    return quality.event_checks(raw, event, bindings.rules(spark, "step_map"), rulebook.LOT_PREFIX)


@query("dq_event", f"WITH {FAB_EVENT}, {_EVENT_CHECKS} SELECT * FROM event_checks")
def dq_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_checks(spark, sf_dir)


_N_RULES = {c: len(rulebook.dicts(f"{c.lower()}_rules")) for c in ("FAB", "KNOB", "MASK", "INLINE", "VM")}
_FEATURE_CHECKS = f"""made AS (SELECT vehicle, category, count(DISTINCT feature) AS n_features FROM long GROUP BY ALL),
    wanted(category, n_rules) AS (VALUES {', '.join(f"('{c}', {n})" for c, n in _N_RULES.items())}),
    feature_checks AS (SELECT v.vehicle, 'feature' AS stage, concat('family_', lower(w.category)) AS name, coalesce(n_features, 0)::double AS n,
      CASE WHEN coalesce(n_features, 0) > 0 OR n_rules = 0 THEN 'ok' ELSE 'fail' END AS status
      FROM (SELECT DISTINCT vehicle FROM step_map) v CROSS JOIN wanted w LEFT JOIN made m ON v.vehicle = m.vehicle AND w.category = m.category)"""


def feature_checks(spark: SparkSession, long: DataFrame) -> DataFrame:
    rows = [(c, f"{c}_{i}") for c, n in _N_RULES.items() for i in range(n)]
    wanted = rule_tables.table(spark, ["category", "feature"], rows)
    return quality.feature_checks(wanted, long, bindings.rules(spark, "step_map").select("vehicle").distinct())


@query("dq_feature", f"WITH {LONG}, {_FEATURE_CHECKS} SELECT * FROM feature_checks")
def dq_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_checks(spark, common.long_features(spark, sf_dir))


_SEND_CHECKS = """filled AS (SELECT feature FROM long GROUP BY feature HAVING bool_or(trim(coalesce(value_str, '')) <> '' OR value_num IS NOT NULL)),
    sent AS (SELECT feature, CASE WHEN starts_with(feature, 'KNOB_') THEN 'send_knob' WHEN starts_with(feature, 'FAB_') OR starts_with(feature, 'MASK_') THEN 'send_fab'
      WHEN starts_with(feature, 'VM_') THEN 'send_vm' WHEN starts_with(feature, 'INLINE_') THEN 'send_inline' END AS name, starts_with(feature, 'MASK_') AS lost FROM filled),
    send_checks AS (SELECT v.vehicle, 'send' AS stage, g.name, (count(*) FILTER (WHERE lost))::double AS n,
        CASE WHEN count(feature) = 0 THEN 'skip' WHEN count(*) FILTER (WHERE lost) > 0 THEN 'fail' ELSE 'ok' END AS status
      FROM (SELECT DISTINCT vehicle FROM step_map) v CROSS JOIN (VALUES ('send_knob'), ('send_fab'), ('send_vm'), ('send_inline')) AS g(name) LEFT JOIN sent s ON s.name = g.name GROUP BY ALL)"""
_CHECKS = f"""{_RAW_CHECKS}, {_EVENT_CHECKS}, {_FEATURE_CHECKS}, {_SEND_CHECKS},
    checks AS (SELECT * FROM raw_checks UNION ALL SELECT * FROM event_checks UNION ALL SELECT * FROM feature_checks UNION ALL SELECT * FROM send_checks),
    graded AS (SELECT *, CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END AS grade,
      CASE stage WHEN 'raw' THEN 0 WHEN 'event' THEN 1 WHEN 'feature' THEN 2 WHEN 'send' THEN 3 ELSE 4 END AS stage_order FROM checks)"""


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of all stages; a send group that lost its MASK columns among them."""
    long = cut_lineage(common.long_features(spark, sf_dir))
    columns = wide.filled_features(long)
    groups = {g: [c for c in wide.send_columns(columns, g) if not c.startswith("MASK_")] for g in wide.SEND_GROUPS}
    send = [row for v in rulebook.VEHICLES for row in quality.send_checks(v, columns, groups, wide.SEND_GROUPS)]
    out = raw_checks(spark, sf_dir).unionByName(event_checks(spark, sf_dir)).unionByName(feature_checks(spark, long))
    return out.unionByName(spark.createDataFrame(send, out.schema))


@query("dq_summary", f"""WITH {LONG}, {_CHECKS}, stages AS (SELECT vehicle, stage, stage_order, max(grade) AS worst, count(*) FILTER (WHERE grade = 2) AS failed,
        count(*) FILTER (WHERE grade = 1) AS warned, bool_and(status = 'skip') AS skipped FROM graded GROUP BY ALL)
    SELECT vehicle, stage, CASE WHEN skipped THEN 'skip' WHEN worst = 2 THEN 'fail' WHEN worst = 1 THEN 'warn' ELSE 'ok' END AS status, failed, warned,
      CASE max(worst) OVER v WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'ok' END AS overall,
      arg_min(stage, stage_order) FILTER (WHERE worst = 2) OVER v AS blocked_at FROM stages WINDOW v AS (PARTITION BY vehicle)""")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(checks(spark, sf_dir))


@query("dq_digest", f"""WITH {LONG}, {_CHECKS} SELECT vehicle, stage, name, n, status,
      row_number() OVER (PARTITION BY vehicle ORDER BY grade DESC, stage_order, name) AS rank FROM graded WHERE grade > 0""")
def dq_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(checks(spark, sf_dir))


_PRODUCT_CHECKS = """fab_wafers AS (SELECT vehicle, root_lot_id, wafer_id, max(tkout_time) AS written FROM event GROUP BY ALL),
    inline_wafers AS (SELECT vehicle, root_lot_id, wafer_id, max(tkout_time) AS written FROM inline_event GROUP BY ALL),
    products AS (SELECT vehicle, coalesce(c.days, 0) AS days, coalesce(b.n, 0) AS built_rows, b.written AS built_at, coalesce(p.n, 0) AS published_rows, p.written AS published_at
      FROM (SELECT DISTINCT vehicle FROM step_map) v
      LEFT JOIN (SELECT vehicle, count(DISTINCT nullif(substr(tkout_time, 1, 10), '')) AS days FROM event GROUP BY vehicle) c USING (vehicle)
      LEFT JOIN (SELECT vehicle, count(*) AS n, max(written) AS written FROM fab_wafers GROUP BY vehicle) b USING (vehicle)
      LEFT JOIN (SELECT vehicle, count(*) AS n, max(written) AS written FROM inline_wafers GROUP BY vehicle) p USING (vehicle)),
    product_checks AS (SELECT vehicle, 'feature' AS stage, 'coverage_days' AS name, days::double AS n, CASE WHEN days > 0 THEN 'ok' ELSE 'warn' END AS status FROM products
      UNION ALL SELECT vehicle, 'feature', 'wide_rows', built_rows::double, CASE WHEN built_rows > 0 THEN 'ok' ELSE 'fail' END FROM products
      UNION ALL SELECT vehicle, 'feature', 'published_rows', published_rows::double,
        CASE WHEN published_at < built_at THEN 'warn' WHEN published_rows > 0 THEN 'ok' ELSE 'fail' END FROM products)"""


def product_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FAB wafers stand for the wide table, measured ones for its published copy, last times for when they were written."""
    event, measured = common.fab_event(spark, sf_dir), common.inline_event(spark, sf_dir)
    day = F.nullif(F.substring("tkout_time", 1, 10), F.lit(""))
    covered = event.groupBy("vehicle").agg(F.count_distinct(day).alias("days"))

    def by_vehicle(rows: DataFrame) -> DataFrame:
        wafers = rows.groupBy("vehicle", "root_lot_id", "wafer_id").agg(F.max("tkout_time").alias("written"))
        return wafers.groupBy("vehicle").agg(F.count("*").alias("n_rows"), F.max("written").alias("written"))

    vehicles = bindings.rules(spark, "step_map").select("vehicle")
    return quality.product_checks(vehicles, covered, by_vehicle(event), by_vehicle(measured))


@query("dq_product", f"WITH {common.FAB_EVENT}, {common.INLINE_EVENT}, {_PRODUCT_CHECKS} SELECT * FROM product_checks")
def dq_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_checks(spark, sf_dir)


_FIXES = ", ".join(f"('{name}', '{fix}')" for name, fix in quality.FIXES.items())


@query("dq_fixes", f"""WITH {LONG}, {_CHECKS}, {_PRODUCT_CHECKS}, todo(name, fix) AS (VALUES {_FIXES}),
    every AS (SELECT vehicle, name, grade, stage_order FROM graded
      UNION ALL SELECT vehicle, name, CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END, 2 FROM product_checks),
    problems AS (SELECT vehicle, name, row_number() OVER (PARTITION BY vehicle ORDER BY grade DESC, stage_order, name) AS place FROM every WHERE grade > 0),
    told AS (SELECT vehicle, fix, min(place) AS place, count(*) AS n_problems FROM problems JOIN todo USING (name) WHERE place <= {quality.DIGEST_ROWS} GROUP BY ALL)
    SELECT vehicle, fix, n_problems, row_number() OVER (PARTITION BY vehicle ORDER BY place) AS rank FROM told QUALIFY rank <= {quality.FIX_ROWS}""")
def dq_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fixes(checks(spark, sf_dir).unionByName(product_checks(spark, sf_dir)))
