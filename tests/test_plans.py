"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from waferline.operators.ranking import first_texts
from waferline.operators.wide import keep_last

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "cast(id AS string) AS v")
    text = plan(first_texts(df, ["k"], "v", 5, "out"))
    assert "row_number(), 5, Partial" in text


def test_last_row_is_combined_on_the_map_side(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    assert "partial_max(struct(v" in plan(keep_last(df, ["k"], ["v"]))


@pytest.mark.parametrize("name", ["knob_miss", "step_neighbors", "skip_auto", "alert_list", "dq_event", "key_batch_fetch"])
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_scans_read_the_columns_they_need(spark):
    text = plan(entry.queries()["step_id_parse"](spark, SF))
    # the step comes from one column; the first column only spreads a small file
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "event")
    spark.range(100).selectExpr("id", "concat('S', id % 3) AS step_desc").write.parquet(path)
    from waferline.operators.features import TextRule, _rows_of_steps

    rows = _rows_of_steps(spark.read.parquet(path), [TextRule("f", "S1", "ppid", "last"), TextRule("g", "S2", "ppid", "last")])
    assert "PushedFilters: [In(step_desc, [S1,S2])" in plan(rows.select(F.col("id")))


def test_picks_are_sorted_by_a_hash_and_the_event_table_is_narrow(spark, monkeypatch):
    from waferline.plans import common

    written = []
    cut = common.cut_lineage
    monkeypatch.setattr(common, "cut_lineage", lambda df, **options: written.append(df.columns) or cut(df, **options))
    text = plan(common.long_features(spark, SF))
    assert "key=[_hash#" in text and written == [common.FEATURE_COLUMNS]


def test_groups_by_hash_are_the_groups(spark):
    from waferline.operators.ranking import by_hash

    df = spark.range(3_000).selectExpr("nullif(concat('k', id % 50), 'k7') AS a", "nullif(id % 3, 1) AS b", "cast(id AS string) AS v")
    got = by_hash(df, ["a", "b"]).agg(F.max("v").alias("v"), F.count("*").alias("n")).drop("_hash")
    want = df.groupBy("a", "b").agg(F.max("v").alias("v"), F.count("*").alias("n"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and got.count() == 150
