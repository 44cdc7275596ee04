"""The wide table, publishing, a whole run, and the streaming forms."""

import os

import pytest
from pyspark.sql import functions as F

from waferline.operators import alerts, wide
from waferline.plans import full_run
from waferline.sources import commits, partitions
from waferline.sources import rules as rule_tables
from waferline.sources.schema import FAB, INLINE, VM
from waferline.streaming import incremental

LONG = "vehicle string, root_lot_id string, wafer_id string, feature string, value_str string, value_num double"


def test_column_order():
    names = ["VM_1", "X", "FAB_10 A", "FAB_2.5 B", "FAB_none", "KNOB_3", "MASK_1", "INLINE_0"]
    assert wide.ordered_columns(names) == ["KNOB_3", "FAB_2.5 B", "FAB_10 A", "FAB_none", "MASK_1", "INLINE_0", "VM_1", "X"]


def test_column_order_as_a_table(spark):
    names = ["VM_1", "X", "FAB_10 A", "FAB_2.5 B", "FAB_none", "KNOB_3", "MASK_1", "INLINE_0"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r["name"] for r in df.orderBy(*wide.column_order_key("name")).collect()] == wide.ordered_columns(names)


def test_pivot(spark):
    rows = [("V", " R1", "W01", "FAB_2", "a", None), ("V", "R1", "1", "VM_x", None, 2.5), ("V", "R2", "x", "FAB_1", "b", None), ("V", "R1", "W1", "FAB_2", "c", None)]
    products = spark.createDataFrame([("V", "P")], "vehicle string, PRODUCT string")
    out = wide.pivot(spark.createDataFrame(rows, LONG), ["FAB_2", "FAB_1"], ["VM_x"], products)
    assert out.columns == ["vehicle", "PRODUCT", "ROOT_LOT_ID", "WAFER_ID", "FAB_1", "FAB_2", "VM_x"]
    assert {tuple(r) for r in out.collect()} == {("V", "P", "R1", 1, None, "c", 2.5), ("V", "P", "R2", None, "b", None, None)}


def test_pivot_of_many_features(spark):
    names = [f"FAB_{i}" for i in range(400)]
    rows = [("V", "R", str(w), f, f"{w}{f}", None) for w in range(3) for f in names if hash((w, f)) % 3]
    out = wide.pivot(spark.createDataFrame(rows, LONG), names, [], rule_tables.table(spark, ["vehicle", "PRODUCT"], [("W", "P")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    want = {(w, f): v for _, _, w, f, v, _ in rows}
    for r in out.collect():
        assert r["PRODUCT"] == "V" and all(r[f] == want.get((str(r["WAFER_ID"]), f)) for f in names)


def test_checks(spark):
    keys = wide.WIDE_KEY
    def frame(rows):
        return spark.createDataFrame(rows, "PRODUCT string, ROOT_LOT_ID string, WAFER_ID long")
    wide.check(frame([("P", "R", 1), ("P", "R", 2)]), keys)
    for rows, text in (([], "no rows"), ([("P", "R", None)], "null key"), ([("P", "R", 1), ("P", "R", 1)], "repeats")):
        with pytest.raises(ValueError, match=text):
            wide.check(frame(rows), keys)


def test_keep_last(spark):
    df = spark.createDataFrame([("P", "A", None), ("P", "B", 2), ("Q", "A", 1)], "k string, vehicle string, v int")
    assert {(r["k"], r["v"]) for r in wide.keep_last(df, ["k"], ["vehicle"]).collect()} == {("P", 2), ("Q", 1)}


def test_publish_and_send(spark, tmp_path):
    rows = [("V1", "P/1", "R", 1, "old", None), ("V2", "P/1", "R", 1, "new", 1.0), ("V1", "Q", "R", 1, "q", 2.0)]
    table = spark.createDataFrame(rows, "vehicle string, PRODUCT string, ROOT_LOT_ID string, WAFER_ID long, FAB_1 string, MASK_2 double")
    root = str(tmp_path / "pub")
    (tmp_path / "pub" / "product_name=OWN").mkdir(parents=True)
    assert wide.publish(table, root) == ["P_1", "Q"]
    assert {f for f in os.listdir(root) if f.startswith("product")} == {"product_name=OWN", "product_name=P_1", "product_name=Q"}
    assert spark.read.parquet(f"{root}/product_name=P_1").first()["FAB_1"] == "new"
    # a product of the last run that is gone now is removed, other folders stay
    assert wide.publish(table.where("PRODUCT = 'Q'"), root, previous=["P_1", "Q"]) == ["Q"]
    assert {f for f in os.listdir(root) if f.startswith("product")} == {"product_name=OWN", "product_name=Q"}
    assert wide.write_send(table, str(tmp_path / "send")) == {"KNOB": "skipped", "FAB": "written", "VM": "skipped", "INLINE": "skipped"}
    csv = spark.read.option("header", True).csv(str(tmp_path / "send/FAB/csv"))
    assert csv.columns == ["PRODUCT", "ROOT_LOT_ID", "WAFER_ID", "FAB_1", "MASK_2"] and csv.count() == 3


RULES = full_run.Rules(
    step_map=[{"vehicle": "V", "step_id": "S1", "step_desc": "ETCH"}, {"vehicle": "V", "step_id": "S2", "step_desc": "CVD"},
              {"vehicle": "V", "step_id": "S3", "step_desc": "PHOTO"}],
    fab=[{"step_desc": "ETCH", "feature_name": "eqp_id", "agg": "last"}, {"step_desc": "ETCH", "feature_name": "odd", "agg": "last"},
         {"step_desc": "CVD", "feature_name": "ppid", "agg": "concat"}],
    knob=[{"feature_name": "ETCH", "function_step": "ETCH", "rule_order": "R1", "operator": "eq", "value": "P1", "category": "K1"}],
    mask=[{"step_desc": "PHOTO", "agg": "first"}],
    inline=[{"item_id": "CD", "agg": "mean"}],
    vm=[{"sensor_id": "T", "agg": "max"}],
    products={"V": "PROD"},
    lot_prefix="R",
)


def raw_fab(spark, day, wafers, step="S1"):
    cols = [*FAB.columns, "split", "arrival"]
    rows = []
    for i, w in enumerate(wafers):
        r = dict.fromkeys(cols)
        r.update(root_lot_id="R1", wafer_id=str(w), tkout_time=f"{day} 0{i % 10}:00:00", step_id=step, step_desc="RAW",
                 ppid="P1", eqp_id=f"E_{i}", reticle_id="RT1", part_id="PART", arrival=f"{i:03d}", split="s")
        rows.append(tuple(r[c] for c in cols))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_whole_run(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    fab = raw_fab(spark, "2026-01-01", range(1, 8)).unionByName(raw_fab(spark, "2026-01-02", range(1, 9), "S2"))
    fab = fab.unionByName(raw_fab(spark, "2026-01-03", [1], "S3")).unionByName(raw_fab(spark, "2026-01-03", [1], "UNKNOWN"))
    run.add_raw(FAB, "V", fab, "2026-01-09")
    inline = spark.createDataFrame([("R1", "1", "CD", 2.0, "2026-01-02 01", "1"), ("R1", "1", "CD", 4.0, "2026-01-02 01", "2"), ("Q1", "1", "CD", 9.0, "2026-01-02 01", "2")],
                                   "root_lot_id string, wafer_id string, item_id string, value double, tkout_time string, time string")
    run.add_raw(INLINE, "V", inline, "2026-01-09")
    vm = spark.createDataFrame([("R1", "1", "T", "S1", 7.0, "2026-01-02 01", "1")],
                               "root_lot_id string, wafer_id string, sensor_id string, step_id string, residual double, tkout_time string, time string")
    run.add_raw(VM, "V", vm, "2026-01-09")
    done = run.all_stages()
    assert [s["feature"] for s in done["feature"]["skipped"]] == ["FAB_ETCH_odd"] and done["wide"]["published"] == ["PROD"]
    assert done["event"]["FAB"] == {"dates": 3, "rows": 16} and done["event"]["INLINE"] == {"dates": 1, "rows": 2}
    table = {r["WAFER_ID"]: r.asDict() for r in spark.read.parquet(run.path("wide")).collect()}
    assert len(table) == 8 and table[1]["PRODUCT"] == "PROD"
    assert table[1]["INLINE_CD_mean"] == 3.0 and table[1]["VM_T_residual_max"] == 7.0
    assert table[1]["KNOB_ETCH_ppid"] == "K1" and table[1]["MASK_PHOTO_reticle"] == "PART|RT1"
    assert table[8]["KNOB_ETCH_ppid"] == "SKIP"  # it passed CVD, which comes after ETCH
    assert table[8]["FAB_ETCH_eqp_id"] is None and table[8]["FAB_CVD_ppid"] == "P1"
    assert [r["step_id"] for r in spark.read.json(run.path("reports/unmatched")).collect()] == ["UNKNOWN"]
    assert spark.read.parquet(run.path("published")).count() == 8
    assert 0 < run.event(FAB).count() < run.raw(FAB).count()

    assert spark.read.json(run.path("reports/skipped_rules")).first()["feature"] == "FAB_ETCH_odd"
    assert [(r["feature"], r["mode"], r["n_wafers"]) for r in spark.read.json(run.path("reports/knob_skip")).collect()] == [("KNOB_ETCH_ppid", "auto", 1)]
    hint = spark.read.json(run.path("reports/step_hints")).collect()
    assert [r["step_id"] for r in hint] == ["UNKNOWN"] and hint[0]["values"]["ppid"] == ["P1"]
    assert product_checks(run) == {"coverage_days": (3.0, "ok"), "wide_rows": (8.0, "ok"), "published_rows": (8.0, "ok")}
    run.build_wide()  # newer than what is published
    run.check_products()
    assert product_checks(run)["published_rows"] == (8.0, "warn")


def product_checks(run):
    return {r["name"]: (r["n"], r["status"]) for r in run.spark.read.json(run.path("reports/product_checks")).collect()}


def counts(run, source=FAB):
    return {r["date"]: r["count"] for r in run.event(source).groupBy("date").count().collect()}


def test_a_second_refresh_rebuilds_what_changed(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", range(1, 8)).unionByName(raw_fab(spark, "2026-01-02", range(1, 9), "S2")), "2026-01-09")
    run.add_raw(FAB, "W", raw_fab(spark, "2026-01-01", range(1, 8)), "2026-01-09")  # a vehicle without a step map
    first = {(r["vehicle"], r["date"], r["reason"], r["n_rows"]) for r in run.refresh_events(FAB).collect()}
    assert first == {("V", "2026-01-01", "missing", 7), ("V", "2026-01-02", "missing", 8), ("W", "2026-01-01", "missing", 0)}
    assert run.refresh_events(FAB).collect() == [] and run.stale_events(FAB).isEmpty()
    # late rows replace one date, and the date of them alone is rebuilt
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", [1, 2]), "2026-01-09")
    assert [(r["date"], r["reason"], r["n_rows"]) for r in run.refresh_events(FAB).collect()] == [("2026-01-01", "newer raw", 2)]
    assert counts(run) == {"2026-01-01": 2, "2026-01-02": 8}
    # a date that yields no event any more loses its rows
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", [1, 2], "UNKNOWN"), "2026-01-09")
    assert [r["n_rows"] for r in run.refresh_events(FAB).collect()] == [0]
    assert counts(run) == {"2026-01-02": 8} and run.refresh_events(FAB).collect() == []
    # another lot prefix makes all dates stale, and none of them keeps a row
    changed = full_run.Run(spark, str(tmp_path), full_run.Rules(step_map=RULES.step_map, lot_prefix="ZZZ"))
    assert {r["reason"] for r in changed.refresh_events(FAB).collect()} == {"version"}
    assert counts(changed) == {} and changed.refresh_events(FAB).collect() == []


def test_one_source_goes_stale_alone(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", [1]), "2026-01-09")
    rows = [("R1", "1", item, 2.0, "2026-01-02 01", "1") for item in ("CD", "OVL")]
    run.add_raw(INLINE, "V", spark.createDataFrame(rows, "root_lot_id string, wafer_id string, item_id string, value double, tkout_time string, time string"), "2026-01-09")
    for source in (FAB, INLINE):
        run.refresh_events(source)
    more = full_run.Run(spark, str(tmp_path), full_run.Rules(step_map=RULES.step_map, inline=[{"item_id": "CD"}, {"item_id": "OVL"}], lot_prefix="R"))
    assert more.stale_events(FAB).isEmpty() and [r["reason"] for r in more.stale_events(INLINE).collect()] == ["version"]
    more.refresh_events(INLINE)
    assert {r["item_id"] for r in more.event(INLINE).collect()} == {"CD", "OVL"}
    assert more.event(INLINE).drop("arrival", "split").columns[:7] == INLINE_COLUMNS


INLINE_COLUMNS = ["root_lot_id", "wafer_id", "item_id", "value", "measure_pos", "tkout_time", "time"]


def test_retention_on_the_layout_of_a_run(spark, tmp_path):
    rules = full_run.Rules(step_map=RULES.step_map, lot_prefix="R", keep_days=7)
    run = full_run.Run(spark, str(tmp_path), rules)
    run.add_raw(FAB, "V", raw_fab(spark, "2020-01-01", [1, 2]).unionByName(raw_fab(spark, "2026-08-01", [1])), "2026-08-01")
    run.refresh_events(FAB)
    assert run.prune("2026-08-01") == {"raw": ["2020-01-01"], "event": ["2020-01-01"]}
    assert counts(run) == {"2026-08-01": 1} and {r["date"] for r in run.raw(FAB).collect()} == {"2026-08-01"}
    assert [r["date"] for r in run.log("event", partitions.PARTITIONS).snapshot().collect()] == ["2026-08-01"]
    assert run.refresh_events(FAB).collect() == []


def test_failed_raw_keeps_what_was_published(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", range(1, 5)), "2026-01-09")
    run.all_stages()
    before = sorted(os.listdir(run.path("published/product_name=PROD")))
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", [1]), "2026-01-09")
    done = run.all_stages(raw_errors=["FAB 2026-01-02"])
    assert done["event"]["FAB"] == {"dates": 1, "rows": 1} and done["wide"]["raw_errors"] == 1
    assert sorted(os.listdir(run.path("published/product_name=PROD"))) == before and spark.read.parquet(run.path("wide")).count() == 4


def test_a_product_that_is_gone_is_unpublished(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    schema = "vehicle string, PRODUCT string, ROOT_LOT_ID string, WAFER_ID long, FAB_1 string"
    for products, folders in ((["P", "Q"], {"P", "Q"}), (["Q"], {"Q"}), (["P"], {"P"})):
        rows = [("V", p, "R", 1, "x") for p in products]
        commits.replace_table(spark.createDataFrame(rows, schema), run.path("wide"))
        assert run.publish() == products
        assert {f[13:] for f in os.listdir(run.path("published")) if f.startswith("product_name=")} == folders


def test_no_events_stop_the_features_only(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", [1], "UNKNOWN"), "2026-01-09")
    done = run.all_stages()
    assert done["feature"] == {"not run": "no event rows"} and not os.path.exists(run.path("wide"))
    assert [r["step_id"] for r in spark.read.json(run.path("reports/unmatched")).collect()] == ["UNKNOWN"]


def test_refused_tables_leave_the_former_one(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int"
    assert commits.replace_table(spark.createDataFrame([("a", 1), ("b", 2)], schema), path, ["k"], ["k"]) == 2
    for rows, text in (([], "no rows"), ([(None, 1)], "null in k"), ([("a", 1), ("a", 2)], "repeated keys")):
        with pytest.raises(commits.Refused, match=text):
            commits.replace_table(spark.createDataFrame(rows, schema).repartition(3), path, ["k"], ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]
    assert sorted(os.listdir(tmp_path)) == ["t"]
    assert commits.replace_table(spark.createDataFrame([("c", 3)], schema), path, ["k"], ["k"]) == 1
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("c", 3)]


def test_replaced_partitions_with_odd_names(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "v int, a string, b string"
    first = spark.createDataFrame([(1, "x/y", "1%2"), (2, "p", "q"), (3, "p", "r")], schema)
    commits.replace_partitions(first, path, ["a", "b"], first)
    expected = spark.createDataFrame([("x/y", "1%2"), ("p", "q")], "a string, b string")
    got = commits.replace_partitions(spark.createDataFrame([(9, "x/y", "1%2"), (8, "x/y", "1%2")], schema), path, ["a", "b"], expected)
    assert {tuple(r) for r in got.collect()} == {("x/y", "1%2", 2), ("p", "q", 0)}
    assert {tuple(r) for r in spark.read.schema(schema).parquet(path).collect()} == {(9, "x/y", "1%2"), (8, "x/y", "1%2"), (3, "p", "r")}


def test_commit_log_takes_the_newest_entry(spark, tmp_path):
    log = commits.CommitLog(spark, str(tmp_path / "log"), ["k"])
    assert log.snapshot().collect() == []
    def entries(rows):
        return spark.createDataFrame(rows, "k string, version string, n_rows long, removed boolean").withColumn("written", F.lit("2026-01-01").cast("timestamp"))
    assert [log.append(entries(rows)) for rows in ([("a", "1", 1, False), ("b", "1", 1, False)], [], [("a", "2", 5, False), ("b", "2", 0, True)], [("c", "2", 1, False)])] == [1, 2, 3, 4]
    assert {(r["k"], r["version"], r["n_rows"]) for r in log.snapshot().collect()} == {("a", "2", 5), ("c", "2", 1)}
    assert log.snapshot(with_removed=True).count() == 3


def test_deleted_rules_leave_the_feature_table(spark, tmp_path):
    run = full_run.Run(spark, str(tmp_path), RULES)
    run.add_raw(FAB, "V", raw_fab(spark, "2026-01-01", range(1, 4)), "2026-01-09")
    run.refresh_events(FAB)
    run.build_features()
    assert {r["feature"] for r in run.long().select("feature").distinct().collect()} == {"FAB_ETCH_eqp_id", "KNOB_ETCH_ppid"}
    less = full_run.Run(spark, str(tmp_path), full_run.Rules(step_map=RULES.step_map, fab=RULES.fab[:1], lot_prefix="R"))
    less.build_features()
    assert {r["feature"] for r in less.long().select("feature").distinct().collect()} == {"FAB_ETCH_eqp_id"}


def test_a_bad_step_map_stops_the_run(spark, tmp_path):
    bad = full_run.Rules(step_map=[{"vehicle": "V", "step_id": "S1", "step_desc": d} for d in "AB"])
    with pytest.raises(ValueError, match="S1"):
        bad.steps(spark)


def test_late_rows_rebuild_their_date(spark, tmp_path):
    raw_dir, out = str(tmp_path / "raw"), str(tmp_path / "event")
    schema = "lot string, date string"
    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(raw_dir)
    def run():
        stream = incremental.read_files(spark, raw_dir, spark.createDataFrame([], schema).schema)
        incremental.rebuild_dates(stream, lambda: spark.read.schema(schema).parquet(raw_dir), lambda df: df.where("lot LIKE 'R%'"),
                                  out, str(tmp_path / "state")).awaitTermination()
        return sorted((r["date"], r["lot"]) for r in spark.read.schema(schema).parquet(out).collect())
    add([("R1", "d1"), ("Q1", "d1"), ("R2", "d2")])
    assert run() == [("d1", "R1"), ("d2", "R2")]
    add([("R3", "d1")])
    assert run() == [("d1", "R1"), ("d1", "R3"), ("d2", "R2")]
    # the rows of a date are replaced by some that make no event
    spark.createDataFrame([("R1", "d1"), ("Q1", "d1"), ("R3", "d1")], schema).coalesce(1).write.mode("overwrite").parquet(raw_dir)
    spark.createDataFrame([("Q9", "d2")], schema).coalesce(1).write.mode("append").parquet(raw_dir)
    assert run() == [("d1", "R1"), ("d1", "R3")]


def test_stream_gate_equals_the_batch_gate(spark, tmp_path):
    rows = [(i % 3, i, "ab"[i % 2], i * 97 % 50 + i * 60) for i in range(200)]
    rows.sort(key=lambda r: r[3])
    df = spark.createDataFrame(rows, "unit long, alert_id long, kind string, second long")
    for part in range(4):
        df.where(F.col("second").between(part * 3000, part * 3000 + 2999)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.gate(incremental.read_files(spark, str(tmp_path / "in"), df.schema, files_per_batch=1), "unit", 3, 900)
    run = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
           .trigger(availableNow=True).start())
    run.awaitTermination()
    got = {(r["alert_id"], r["outcome"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = alerts.gate(df.withColumn("severity", F.lit("error")), "unit", "info", 3, 900)
    assert got == {(r["alert_id"], r["outcome"]) for r in batch.collect()}


def test_stream_drops_repeats_only(spark):
    from waferline.plans import streams

    out = streams.stream_alert_dedupe(spark, "/root/testdata/sf0.001")
    sent = [(r["unit"], r["kind"], r["ts"].timestamp()) for r in out.collect()]
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("user_id", "event_type", "cast(ts AS timestamp) AS ts")
    every = {(r[0], r[1], r[2].timestamp()) for r in rows.collect()}
    assert set(sent) <= every and len(set(sent)) == len(sent)
    by_key = {}
    for unit, kind, ts in sorted(sent, key=lambda r: r[2]):
        by_key.setdefault((unit, kind), []).append(ts)
    assert all(b - a >= 12 * 3600 for times in by_key.values() for a, b in zip(times, times[1:]))
    assert set(by_key) == {(u, k) for u, k, _ in every}


def test_stream_gate_over_all_events(spark):
    from waferline.plans import streams

    sf = "/root/testdata/sf0.001"
    got = {(r["alert_id"], r["outcome"]) for r in streams.stream_alert_gate(spark, sf).collect()}
    rows = streams.alerts(spark, sf).where("value > 20").select("unit", "alert_id", "kind", F.unix_seconds("ts").alias("second"))
    batch = alerts.gate(rows.withColumn("severity", F.lit("error")), "unit", "info", 2, 43_200)
    assert got == {(r["alert_id"], r["outcome"]) for r in batch.collect()}


def test_stream_gate_calls_python_by_buckets_not_by_scopes(spark, tmp_path):
    """Scopes of one bucket, a null one among them, keep their own caps and windows over batches."""
    big = 2**53 + 1
    rows = [(None if u == 3 else big + u, u * 100 + i, "ab"[i % 2], i * 700) for u in range(5) for i in range(12)]
    df = spark.createDataFrame(rows, "unit long, alert_id long, kind string, second long")
    results = {}
    for buckets in (1, 1_000):
        out = tmp_path / f"out{buckets}"
        for wave, part in enumerate(("second < 4000", "second >= 4000")):
            df.where(part).coalesce(1).write.mode("overwrite" if wave == 0 else "append").parquet(str(tmp_path / f"in{buckets}"))
            stream = incremental.gate(incremental.read_files(spark, str(tmp_path / f"in{buckets}"), df.schema), "unit", 2, 1_500, buckets)
            run = (stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / f"state{buckets}"))
                   .trigger(availableNow=True).start())
            run.awaitTermination()
        results[buckets] = {tuple(r) for r in spark.read.parquet(str(out)).select("unit", "alert_id", "outcome").collect()}
    batch = alerts.gate(df.where("unit IS NOT NULL").withColumn("severity", F.lit("error")), "unit", "info", 2, 1_500)
    want = {(r["unit"], r["alert_id"], r["outcome"]) for r in batch.collect()}
    assert results[1] == results[1_000] and len(results[1]) == 60
    assert {r for r in results[1] if r[0] is not None} == want
