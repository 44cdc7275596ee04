"""Schemas, partitions, rule files and extraction units."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.operators import event as events
from waferline.sources import adhoc, extract, partitions
from waferline.sources import rules as rule_tables
from waferline.sources.schema import FAB, INLINE, Source, drift_union, missing_columns


def test_drift_union_fills_and_casts(spark):
    one = spark.createDataFrame([("R1", "2026-01-01 10:00:00", "1")], "root_lot_id string, tkout_time string, wafer_id string")
    two = spark.createDataFrame([("R2", 7)], "root_lot_id string, wafer_id int")
    rows = drift_union([one, two], FAB.schema).select("root_lot_id", "wafer_id", "tkout_time").orderBy("root_lot_id").collect()
    assert [tuple(r) for r in rows] == [("R1", "1", "2026-01-01 10:00:00"), ("R2", "7", None)]
    assert missing_columns(two, ["root_lot_id", "ppid"]) == ["ppid"]


def test_text_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("R1", "x"), ("R2", "1.5")], "root_lot_id string, value string")
    assert [r["value"] for r in drift_union([df], INLINE.schema).orderBy("root_lot_id").collect()] == [None, 1.5]


def test_partition_time_column():
    assert FAB.partition_time() == "tkout_time"
    assert Source("X", ("a", "Meas_Time", "time"), default_time="tkout_time").partition_time() == "Meas_Time"
    assert Source("X", ("a",)).partition_time() is None
    with pytest.raises(ValueError):
        Source("X", ("a",), time_col="b").partition_time()


RAW = "root_lot_id string, wafer_id string, tkout_time string, item_id string, value double, split string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_write_replaces_only_touched_dates(spark, tmp_path):
    root = str(tmp_path / "raw")
    first = [("R1", "1", "2026-01-01 01", "CD", 1.0, "s"), ("R1", "2", "2026-01-02 01", "CD", 2.0, "s"), ("R1", "3", "", "CD", 3.0, "s")]
    assert partitions.write(raw(spark, first), root, INLINE, "V", "2026-01-09")
    assert partitions.write(raw(spark, [("R1", "9", "2026-01-02 05", "CD", 9.0, "s")]), root, INLINE, "V", "2026-01-09")
    assert not partitions.write(raw(spark, []), root, INLINE, "V", "2026-01-01")
    got = {(r["date"], r["wafer_id"]) for r in partitions.scan(spark, root, INLINE, "V").collect()}
    assert got == {("2026-01-01", "1"), ("2026-01-02", "9"), ("2026-01-09", "3")}
    recent = partitions.scan(spark, root, INLINE, "V", last_days=2, today="2026-01-03")
    assert {r["date"] for r in recent.collect()} == {"2026-01-02", "2026-01-09"}
    assert "PartitionFilters: [isnotnull(source" in recent._jdf.queryExecution().executedPlan().toString()
    assert partitions.scan(spark, root, INLINE, "OTHER").isEmpty()


def test_empty_frame_keeps_the_schema(spark):
    df = partitions.empty_frame(spark, INLINE)
    assert df.columns == [*INLINE.columns, "split"] and df.isEmpty()


def test_retention(spark, tmp_path):
    for d in ("2020-01-01", "2026-08-01", "bad"):
        (tmp_path / f"date={d}").mkdir()
    assert partitions.delete_expired(spark, str(tmp_path), 7, "2026-08-01") == ["2020-01-01"]
    assert sorted(os.listdir(tmp_path)) == ["date=2026-08-01", "date=bad"]
    assert partitions.delete_expired(spark, str(tmp_path), 0, "2030-01-01") == []


def test_stale_partitions(spark):
    raw_manifest = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", 10)], "date string, written int")
    event = spark.createDataFrame([("a", 11, "v1"), ("b", 9, "v1"), ("c", 11, "v0")], "date string, written int, version string")
    got = {r["date"]: r["reason"] for r in partitions.stale_partitions(raw_manifest, event, ["date"], "v1").collect()}
    assert got == {"b": "newer raw", "c": "version", "d": "missing"}
    assert partitions.settings_version({"a": 1}) != partitions.settings_version({"a": 2})


def test_fingerprints_ignore_row_order(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id", "cast(id AS string) AS t")
    one = partitions.fingerprints(df, ["k"], ["id", "t"])
    two = partitions.fingerprints(df.orderBy(F.col("id").desc()), ["k"], ["id", "t"])
    assert partitions.changed(one, two, ["k"]).isEmpty()
    other = partitions.fingerprints(df.where("id <> 4"), ["k"], ["id", "t"])
    assert [r["k"] for r in partitions.changed(one, other, ["k"]).collect()] == [1]


def test_event_takes_the_mapped_description(spark):
    rows = spark.createDataFrame([("R1", " CC999900", "RAW"), ("Q1", "CC999900", "RAW"), ("R1", "CC1", "RAW")],
                                 "root_lot_id string, step_id string, step_desc string")
    steps = spark.createDataFrame([("CC999900", "GATE_ETCH")], "step_id string, step_desc string")
    got = events.build(rows, FAB, "R", steps, ["step_id"], []).collect()
    assert [(r["root_lot_id"], r["step_desc"]) for r in got] == [("R1", "GATE_ETCH")]


def test_keyless_dates(spark):
    df = spark.createDataFrame([("a", " "), ("a", None), ("b", "R1")], "date string, root_lot_id string")
    assert [r["date"] for r in events.keyless_dates(df, "date").collect()] == ["a"]


def test_rule_files(spark, tmp_path):
    assert rule_tables.read_csv(spark, str(tmp_path / "none.csv"), ["a"]) is None
    (tmp_path / "r.csv").write_text("a,b\n1,x\n,y\n")
    rows = rule_tables.read_csv(spark, str(tmp_path / "r.csv"), ["a", "b", "c"]).collect()
    assert [tuple(r) for r in rows] == [("1", "x", None), (None, "y", None)]
    with pytest.raises(ValueError, match="no column c"):
        rule_tables.read_csv(spark, str(tmp_path / "r.csv"), ["a"], required=["a", "c"])


def test_rules_on_the_driver_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(rule_tables, "MAX_DRIVER_RULES", 3)
    assert len(rule_tables.on_driver(spark.range(3))) == 3
    with pytest.raises(ValueError):
        rule_tables.on_driver(spark.range(4))
    with pytest.raises(ValueError):
        rule_tables.table(spark, ["a"], [("x",)] * 4)


def test_item_lists(spark):
    assert rule_tables.allowed_items(None, configured=False) is None
    with pytest.raises(ValueError):
        rule_tables.allowed_items(None)
    df = spark.createDataFrame([("real ", " A "), ("REAL", "A"), ("ADDP", "B"), (None, "C"), ("REAL", " ")], "CATEGORY string, ITEMID string")
    assert [r["item_id"] for r in rule_tables.allowed_items(df).collect()] == ["A"]


def test_step_map_conflicts(spark):
    df = spark.createDataFrame([("S1", "A", 0), (" S1", "B", 1), ("S2", "A", 2), ("S2", "A ", 3), ("", "A", 4)], "step_id string, step_desc string, pos int")
    assert [tuple(r) for r in rule_tables.conflicts(df, ["step_id"]).collect()] == [("S1", 2, "A,B")]
    assert {r["step_id"]: r["step_desc"] for r in rule_tables.unique_steps(df, ["step_id"]).collect()} == {"S1": "B", "S2": "A"}


def test_windows_do_not_overlap(spark):
    units = spark.createDataFrame([("V", 3, 1)], "vehicle string, span int, split int")
    got = sorted((r["start"], r["end"]) for r in extract.windows(units, "2026-07-28", "span", "split").collect())
    days = [date(2026, 7, d) for d in (25, 26, 27, 28, 29)]
    assert got == list(zip(days, days[1:]))


def test_windows_wider_than_the_rest(spark):
    units = spark.createDataFrame([("V", 5, 3), ("W", 0, 2)], "vehicle string, span int, split int")
    got = sorted((r["vehicle"], str(r["start"])[5:], str(r["end"])[5:]) for r in extract.windows(units, "2026-07-28", "span", "split").collect())
    assert got == [("V", "07-23", "07-26"), ("V", "07-26", "07-28"), ("V", "07-28", "07-29"), ("W", "07-28", "07-29")]


def test_no_keys_fetch_no_rows(spark):
    table = spark.createDataFrame([("R1",), ("R2",)], "root_lot_id string")
    none = spark.createDataFrame([("",), (None,)], "root_lot_id string")
    assert extract.rows_of_keys(table, none, "root_lot_id").isEmpty()
    some = spark.createDataFrame([("R2",), ("R2",), (None,)], "root_lot_id string")
    assert extract.rows_of_keys(table, some, "root_lot_id").count() == 1


def test_adhoc_sql(spark):
    df = spark.range(5000).withColumnRenamed("id", "n")
    assert adhoc.view(df, "").count() == 200
    assert adhoc.view(df, "n < 10").count() == 10
    assert adhoc.view(df, "n >= 0", 9999).count() == 2000
    assert adhoc.view(df, "SELECT max(n) AS m FROM t").first()["m"] == 4999


def test_log_lines(spark):
    from waferline.operators.runs import parse_log

    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": '), (3, ""), (4, '{"k": 4, "x": 0}')], "id int, line string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    assert sorted((r["id"], r["k"]) for r in parse_log(df, "line", schema).collect()) == [(1, 1), (4, 4)]
