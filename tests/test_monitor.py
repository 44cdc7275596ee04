"""Runs, retries, health, alerts and quality checks."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from waferline.operators import alerts, quality, runs

STAGES = "vehicle string, source string, stage string, latest_date string, built string"
NOW = "2026-08-10 12:00:00"


def health(spark, rows, today="2026-08-10"):
    """Rows of (stage, newest date, days since it was built)."""
    days = [("V", "FAB", s, d, None if age is None else f"2026-08-{10 - age:02d} 11:00:00") for s, d, age in rows]
    df = spark.createDataFrame(days, STAGES).withColumn("built", F.col("built").cast("timestamp_ntz"))
    found = alerts.stage_health(df, today, F.lit(NOW).cast("timestamp_ntz"), 1, ["feature", "wide", "publish", "send"])
    return {r["stage"]: r for r in found.collect()}


def test_yesterday_is_not_stalled_two_days_are(spark):
    assert not health(spark, [("raw", "2026-08-09", 1)])["raw"]["stalled"]
    old = health(spark, [("raw", "2026-08-08", 1)])["raw"]
    assert old["stalled"] and old["lag_days"] == 2 and not old["cascade"]


def test_event_behind_a_fresh_raw_is_its_own_problem(spark):
    rows = health(spark, [("raw", "2026-08-10", 0), ("event", "2026-08-07", 0)])
    assert rows["event"]["stalled"] and rows["event"]["behind_days"] == 3 and not rows["event"]["cascade"]


def test_old_raw_is_the_cause_and_event_a_cascade(spark):
    rows = health(spark, [("raw", "2026-08-07", 1), ("event", "2026-08-07", 1)])
    assert rows["raw"]["stalled"] and not rows["raw"]["cascade"]
    assert rows["event"]["stalled"] and rows["event"]["cascade"]


def test_later_stages_are_judged_by_their_builds(spark):
    fresh = [("raw", "2026-08-10", 0), ("event", "2026-08-10", 0), ("feature", "2026-08-10", 0), ("wide", None, 0)]
    rows = health(spark, [*fresh, ("publish", None, None), ("send", None, None)])
    assert not rows["wide"]["stalled"] and rows["wide"]["behind_of"] == "feature"
    assert rows["publish"]["reason"] == rows["send"]["reason"] == "missing" and not rows["publish"]["cascade"]
    rows = health(spark, [*fresh, ("publish", None, 0), ("send", None, 0)])
    assert not any(r["stalled"] for r in rows.values())
    assert health(spark, [("event", "2026-08-10", 0), ("feature", None, 0)])["feature"]["reason"] == "missing"


def test_a_run_that_stopped_has_one_cause(spark):
    rows = health(spark, [("feature", "2026-08-10", 4), ("wide", None, 4), ("publish", None, 4), ("send", None, 4)])
    assert all(rows[s]["stalled"] and rows[s]["cascade"] and rows[s]["reason"] == "old" for s in ("wide", "publish", "send"))


def test_send_behind_the_wide_table_is_a_cause(spark):
    rows = health(spark, [("feature", "2026-08-10", 0), ("wide", None, 0), ("send", None, 5)])
    assert rows["send"]["behind_days"] == 5 and rows["send"]["reason"] == "behind wide 5; old" and not rows["send"]["cascade"]


def test_stall_alert_ids(spark):
    df = spark.createDataFrame([("V", "FAB", "raw", "2026-08-01", NOW), ("W", "FAB", "send", None, None)], STAGES)
    judged = alerts.stage_health(df, "2026-08-10", F.lit(NOW).cast("timestamp"), 1, [])
    assert {r["id"] for r in alerts.stall_alerts(judged, ["send"]).collect()} == {"stall|V|raw|FAB", "stall|-|send|FAB"}


def test_completeness_order(spark):
    rows = [
        ("empty", "success", 500_000, 0), ("partial", "success", 10, 10), ("partial", "failed", 10, 0),
        ("off", "success", 100, 90), ("fine", "success", 1000, 1002), ("unknown", "success", None, 5),
    ]
    df = spark.createDataFrame(rows, "plan string, status string, expected_rows int, actual_rows int")
    got = {r["plan"]: r["outcome"] for r in runs.completeness(df, ["plan"], 0.5).collect()}
    assert got == {"empty": "success_empty", "partial": "partial_failed", "off": "completeness_failed",
                   "fine": "success", "unknown": "success"}


def retry(spark, rows, delays=(5, 15)):
    df = spark.createDataFrame(rows, "unit string, s int, status string").selectExpr("unit", "cast(timestamp_seconds(s) AS timestamp_ntz) AS ts", "status")
    out = runs.retry_state(df, F.lit("1970-01-01 00:20:00").cast("timestamp_ntz"), delays)
    return {r["unit"]: r for r in out.withColumn("next", F.unix_seconds(F.col("next_retry").cast("timestamp"))).collect()}


def test_retry_delays_and_block(spark):
    one = retry(spark, [("u", 1000, "failed")])["u"]
    assert (one["attempts"], one["next"], one["status"], one["severity"]) == (1, 1005, "retry_wait", "warning")
    two = retry(spark, [("u", 1000, "failed"), ("u", 1010, "failed")])["u"]
    assert (two["attempts"], two["next"]) == (2, 1025)
    five = [("u", 1000 + i, "failed") for i in range(5)]
    blocked = retry(spark, five)["u"]
    assert (blocked["status"], blocked["next"], blocked["severity"]) == ("blocked", None, "critical")
    resumed = retry(spark, [*five, ("u", 1100, "resumed")])["u"]
    assert (resumed["attempts"], resumed["total_attempts"], resumed["next"], resumed["status"]) == (0, 5, 1100, "retry_wait")
    assert retry(spark, [*five, ("u", 1100, "success")]) == {}


def reference_gate(rows, floor, cap, window):
    """The rule, walked row by row."""
    recent, last, out = defaultdict(list), {}, {}
    for scope, alert, kind, severity, second in sorted(rows, key=lambda r: (r[4], r[1])):
        if alerts.SEVERITY_RANK.get(severity, 0) < alerts.SEVERITY_RANK[floor]:
            out[alert] = "severity"
            continue
        recent[scope] = [t for t in recent[scope] if second - t < 3600]
        if cap and len(recent[scope]) >= cap:
            out[alert] = "rate_limit"
        elif second - last.get((scope, kind), -window) < window:
            out[alert] = "dedupe"
        else:
            last[scope, kind] = second
            recent[scope].append(second)
            out[alert] = "sent"
    return out


GATE = "scope string, alert_id long, kind string, severity string, second long"


def test_gate_by_example(spark):
    rows = [("s", 1, "a", "info", 0), ("s", 2, "a", "warning", 1), ("s", 3, "a", "warning", 30), ("s", 4, "b", "error", 40),
            ("s", 5, "c", "error", 50), ("s", 6, "a", "error", 3700)]
    out = alerts.gate(spark.createDataFrame(rows, GATE), "scope", "warning", 2, 60)
    assert {r["alert_id"]: r["outcome"] for r in out.collect()} == {
        1: "severity", 2: "sent", 3: "dedupe", 4: "sent", 5: "rate_limit", 6: "sent"}


def test_gate_outcomes_are_the_rules(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"s{i % 5}", i, rnd.choice("abc"), rnd.choice(["info", "warn", "error"]), rnd.choice([0, 9_000, 40_000]) + rnd.randint(0, 6_000)) for i in range(1500)]
    for cap, window in ((0, 300), (4, 300), (3, 1), (2, 0), (0, 0), (3, 5_000)):
        want = reference_gate(rows, "warn", cap, window)
        got = {r["alert_id"]: r["outcome"] for r in alerts.gate(spark.createDataFrame(rows, GATE), "scope", "warn", cap, window).collect()}
        assert got == want, (cap, window)


def test_gate_walks_a_second_in_order(spark):
    rows = [("s", 1, "a", "error", 5), ("s", 2, "b", "error", 5), ("s", 3, "a", "error", 5)]
    out = alerts.gate(spark.createDataFrame(rows, GATE), "scope", "warning", 2, 60)
    assert {r["alert_id"]: r["outcome"] for r in out.collect()} == {1: "sent", 2: "sent", 3: "rate_limit"}


def test_a_long_pause_cuts_a_scope(spark):
    rows = [("s", i, "a", "error", second) for i, second in enumerate([0, 3_599, 3_600, 7_199, 10_800, 10_801, 50_000])]
    pieces = alerts.timeline_pieces(spark.createDataFrame(rows, GATE), "scope", 3600)
    assert sorted((r["slot"], r["piece"]) for r in pieces.collect()) == [(0, 0), (1, 0), (3, 1), (13, 2)]


def test_gate_tests_the_cap_before_the_repeat(spark):
    rows = [("s", 1, "a", "error", 5), ("s", 2, "a", "error", 5)]
    for cap, second in ((1, "rate_limit"), (2, "dedupe"), (0, "dedupe")):
        out = alerts.gate(spark.createDataFrame(rows, GATE), "scope", "warning", cap, 60)
        assert {r["alert_id"]: r["outcome"] for r in out.collect()} == {1: "sent", 2: second}


def test_partition_state(spark):
    rows = [("p", "c1", "success"), ("q", "c1", "success"), ("q", "c2", "failed"), ("r", "c1", "in_progress"), ("s", "c1", "planned")]
    df = spark.createDataFrame(rows, "p string, c string, status string")
    got = {r["p"]: (r["status"], r["done_chunks"]) for r in runs.partition_status(df, ["p"]).collect()}
    assert got == {"p": ("success", 1), "q": ("partial_failed", 1), "r": ("running", 0), "s": ("planned", 0)}


def test_run_summary_and_tail(spark):
    rows = [(1, 1, "A", True, "auto", 2.0), (2, 2, "B", False, "auto", 4.0), (3, 3, "A", True, "manual", 4.0)]
    df = spark.createDataFrame(rows, "run_id int, ts int, vehicle string, ok boolean, mode string, elapsed_sec double")
    got = {r["vehicle"]: (r["runs"], r["ok"], r["failed"], r["avg_sec"]) for r in runs.run_summary(df, 20).collect()}
    assert got == {"A": (2, 2, 0, 3.0), "B": (1, 0, 1, 4.0)}
    assert {r["vehicle"]: r["runs"] for r in runs.run_summary(df, 1).collect()} == {"A": 1, "B": 1}
    tail = df.withColumn("severity", runs.severity())
    assert [r["run_id"] for r in runs.log_tail(tail, 2).collect()] == [3, 2]
    assert [r["run_id"] for r in runs.log_tail(tail, 9, failed_only=True).collect()] == [2]
    assert [r["run_id"] for r in runs.log_tail(tail, 9, min_severity="warning").collect()] == [2]


def test_alert_list_takes_an_id_once(spark):
    rows = spark.createDataFrame([("x", "t", "W", 1), ("x", "t", "V", 2), ("y", "t", "V", 3)], "id string, type string, vehicle string, n_rows int")
    acks = spark.createDataFrame([("x", alerts.HIDDEN[0], "later")], "id string, status string, note string")
    got = [(r["id"], r["vehicle"], r["status"], r["note"]) for r in alerts.with_status(rows, acks).orderBy(*alerts.active_first()).collect()]
    assert got == [("y", "V", "active", ""), ("x", "V", alerts.HIDDEN[0], "later")]


def test_alert_delta_counts_active_ones(spark):
    def snap(rows):
        return spark.createDataFrame(rows, "id string, status string")
    now = snap([("a", "active"), ("b", alerts.HIDDEN[0]), ("c", "active")])
    before = snap([("b", "active"), ("c", "active"), ("d", "active"), ("e", alerts.HIDDEN[1])])
    assert {(r["id"], r["change"]) for r in alerts.delta(now, before).collect()} == {("a", "new"), ("b", "resolved"), ("d", "resolved")}


def test_fingerprint_follows_ids_status_and_stall_reason(spark):
    def print_of(rows):
        df = spark.createDataFrame([("V", *r) for r in rows], "vehicle string, id string, status string, type string, reason string")
        return alerts.alert_fingerprint(df).first()["fingerprint"]
    base = [("a", "active", "unmatched_step", "x"), ("b", "active", "stage_stall", "lag 2")]
    assert print_of(base) == print_of([base[1], ("a", "active", "unmatched_step", "other")])
    assert print_of(base) != print_of([base[0], ("b", "active", "stage_stall", "lag 3")])
    assert print_of(base) != print_of([("a", "seen", "unmatched_step", "x"), base[1]])


def test_quality_summary(spark):
    rows = [("V", "raw", "rows", 1.0, "ok"), ("V", "raw", "null_lots", 1.0, "warn"), ("V", "event", "event_rows", 0.0, "fail"),
            ("V", "send", "send_vm", 0.0, "skip"), ("V", "feature", "family_vm", 0.0, "fail")]
    df = spark.createDataFrame(rows, "vehicle string, stage string, name string, n double, status string")
    got = {r["stage"]: (r["status"], r["failed"], r["warned"], r["overall"], r["blocked_at"]) for r in quality.summary(df).collect()}
    assert got["raw"] == ("warn", 0, 1, "fail", "event")
    assert got["send"][0] == "skip" and got["feature"][:2] == ("fail", 1)
    assert [r["name"] for r in quality.digest(df, 2).orderBy("rank").collect()] == ["event_rows", "family_vm"]


def test_send_checks():
    rows = quality.send_checks("V", ["KNOB_A", "MASK_B", "FAB_C"], {"KNOB": ["KNOB_A"], "FAB": ["FAB_C"], "VM": []},
                               {"KNOB": ("KNOB_",), "FAB": ("FAB_", "MASK_"), "VM": ("VM_",)})
    assert [(r[2], r[3], r[4]) for r in rows] == [("send_knob", 0.0, "ok"), ("send_fab", 1.0, "fail"), ("send_vm", 0.0, "skip")]


def test_product_checks(spark):
    vehicles = spark.createDataFrame([("V",), ("W",), ("X",)], "vehicle string")
    covered = spark.createDataFrame([("V", 3), ("W", 0)], "vehicle string, days int")
    built = spark.createDataFrame([("V", 5, "2"), ("W", 4, "2")], "vehicle string, n_rows int, written string")
    published = spark.createDataFrame([("V", 5, "2"), ("W", 0, "1")], "vehicle string, n_rows int, written string")
    got = {(r["vehicle"], r["name"]): (r["n"], r["status"]) for r in quality.product_checks(vehicles, covered, built, published).collect()}
    assert [got["V", n] for n in ("coverage_days", "wide_rows", "published_rows")] == [(3.0, "ok"), (5.0, "ok"), (5.0, "ok")]
    assert [got["W", n] for n in ("coverage_days", "wide_rows", "published_rows")] == [(0.0, "warn"), (4.0, "ok"), (0.0, "warn")]
    assert [got["X", n][1] for n in ("coverage_days", "wide_rows", "published_rows")] == ["warn", "fail", "fail"]


def test_fixes_are_told_once(spark):
    names = [("raw", "null_lots", "warn"), ("raw", "null_wafers", "warn"), ("event", "event_rows", "fail"), ("event", "match_pct", "warn"),
             ("feature", "family_vm", "ok"), ("send", "send_fab", "warn"), ("send", "unheard_of", "fail")]
    df = spark.createDataFrame([("V", s, n, 1.0, k) for s, n, k in names], "vehicle string, stage string, name string, n double, status string")
    got = [(r["rank"], r["fix"], r["n_problems"]) for r in quality.fixes(df).orderBy("rank").collect()]
    assert got == [(1, "rebuild the events", 1), (2, "ask the source for the missing keys", 2), (3, "add the unmapped steps to the step map", 1)]
    assert quality.fixes(df.where("status = 'ok'")).isEmpty()


def test_every_anomaly_is_listed_the_gravest_first(spark, tmp_path):
    from waferline.plans import monitor
    from waferline.plans.registry import CHECKS

    # 700 vehicles whose only chunk failed on 2024-01-02, one of them within the last hour
    rows = spark.range(700).selectExpr(
        "id AS event_id", f"CASE WHEN id = 699 THEN TIMESTAMP_NTZ '{monitor.NOW}' - INTERVAL 5 MINUTES ELSE TIMESTAMP_NTZ '2024-01-02 00:00:00' END AS ts",
        "id AS user_id", "'error' AS event_type", "1.0D AS value", "'{}' AS props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    got = [tuple(r) for r in monitor.anomalies(spark, str(tmp_path)).select("subject", "kind", "severity").collect()]
    assert len([r for r in got if r[1] == "chunk_failed"]) == 700 and len(got) == len(set(got)) == 702
    assert got[0] == ("U0000000699/2024-01-30", "chunk_failed", "high") and {r[2] for r in got[1:]} == {"medium"}
    assert "LIMIT" not in CHECKS["anomalies"]
