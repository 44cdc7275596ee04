"""Value rules and ordered aggregates on hand-built rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from waferline.functions import aggregates
from waferline.functions.conditions import check_filter, condition
from waferline.functions.registry import Registry
from waferline.functions.text import clean_dash, first_glob, glob_regex, matches_any_glob, wafer_number
from waferline.operators import features, ranking
from waferline.operators.features import ORDER, WAFER
from waferline.operators.ranking import dense_positions, exact_median, nearest_ranks, running_total

EVENT = "vehicle string, root_lot_id string, wafer_id string, step_id string, step_desc string, tkout_time string, " \
    "arrival string, eqp_id string, chamber_id string, unit_id string, sleuth_order string, ppid string, part_id string, reticle_id string"


def event(spark, rows):
    """Rows of (lot, wafer, step_id, step_desc, time, eqp, chamber, unit, order)."""
    full = [("V", r[0], r[1], r[2], r[3], r[4], f"{i:05d}", r[5], r[6], r[7], r[8], None, None, None) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, EVENT)


def values(df):
    return {(r["root_lot_id"], r["wafer_id"]): r["value_str"] for r in df.collect()}


def fab(spark, rows, rules, registry=None):
    registry = registry or Registry()
    usable, skipped, overrides = features.fab_rules(rules, registry)
    made = features.text_features(event(spark, rows), usable, registry) if usable else None
    return made, skipped, overrides


def rule(value, agg, step="GATE_ETCH"):
    return {"step_desc": step, "feature_name": value, "agg": agg}


def test_valid_or_last_is_forced_for_the_tool(spark):
    rows = [
        ("R1", "1", "S", "GATE_ETCH", "01:00", "EQP_01", "CH", "2", None),
        ("R1", "1", "S", "GATE_ETCH", "02:00", "EQP_01", "CH", "A", None),
        ("R1", "2", "S", "GATE_ETCH", "01:00", "EQP_02", "CH", "3", None),
        ("R1", "2", "S", "GATE_ETCH", "03:00", "EQP_02", "CH", "9", None),
        ("R1", "3", "S", "GATE_ETCH", "01:00", "AUX", "-", "-", None),
        ("R1", "3", "S", "GATE_ETCH", "02:00", "AUX", "CH", "B", None),
    ]
    made, _, overrides = fab(spark, rows, [rule("ecuall", "first")])
    assert values(made) == {("R1", "1"): "EQP_01_CH_2", ("R1", "2"): "EQP_02_CH_9", ("R1", "3"): "AUX_CH_B"}
    assert overrides == [{"feature": "FAB_GATE_ETCH_ecuall", "rule_agg": "first", "applied": "valid_or_last"}]


TOOLS = [
    ("R1", "1", "S", "GATE_ETCH", "01:00", "EQP_01", None, None, None),
    ("R1", "9", "S", "GATE_ETCH", "01:00", "AUX", None, None, None),
]


def test_valid_tool_drops_the_wafer(spark):
    made, _, _ = fab(spark, TOOLS, [rule("eqp_id", "valid_eqp")])
    assert values(made) == {("R1", "1"): "EQP_01"}


def test_own_aggregate_wins_and_keeps_the_wafer(spark):
    own = Registry()
    own.register_agg("valid_eqp", aggregates.VALID_TOOL_FIRST.expr)
    made, _, _ = fab(spark, TOOLS, [rule("eqp_id", "valid_eqp")], own)
    assert values(made) == {("R1", "1"): "EQP_01", ("R1", "9"): None}


def test_own_value_and_aggregate(spark):
    own = Registry()
    own.register_value("tool_name", lambda: F.concat(F.lit("T:"), "eqp_id"))
    own.register_agg("longest", lambda val, order: F.max_by(val, F.length(val)))
    made, _, _ = fab(spark, TOOLS, [rule("tool_name", "longest"), rule("eqp_id", "last")], own)
    got = {(r["wafer_id"], r["feature"]): r["value_str"] for r in made.collect()}
    assert got[("1", "FAB_GATE_ETCH_tool_name")] == "T:EQP_01"
    assert got[("9", "FAB_GATE_ETCH_eqp_id")] == "AUX"


def test_unknown_names_are_skipped_and_the_rest_goes_on(spark):
    made, skipped, _ = fab(spark, TOOLS, [rule("mystery", "last"), rule("eqp_id", "odd"), rule("eqp_id", "last")])
    assert [s["feature"] for s in skipped] == ["FAB_GATE_ETCH_mystery", "FAB_GATE_ETCH_eqp_id"]
    assert values(made) == {("R1", "1"): "EQP_01", ("R1", "9"): "AUX"}


def test_wafer_order_is_filled_by_number(spark):
    rows = [
        ("R1", "2", "CC1", "GATE_ETCH", "01:00", None, None, None, None),
        ("R1", "10", "CC1", "GATE_ETCH", "01:00", None, None, None, ""),
        ("R1", "1", "CC1", "GATE_ETCH", "01:00", None, None, None, "-"),
        ("R2", "3", "CC1", "GATE_ETCH", "01:00", None, None, None, "77"),
        ("R2", "1", "CC1", "GATE_ETCH", "01:00", None, None, None, None),
    ]
    made, _, _ = fab(spark, rows, [rule("sleuth_order", "last")])
    assert values(made) == {("R1", "1"): "1", ("R1", "2"): "2", ("R1", "10"): "3", ("R2", "3"): "77", ("R2", "1"): "1"}


def test_wafer_order_is_per_step(spark):
    rows = [
        ("R1", "5", "CC1", "GATE_ETCH", "01:00", None, None, None, None),
        ("R1", "7", "CC1", "GATE_ETCH", "01:00", None, None, None, None),
        ("R1", "7", "CC2", "GATE_ETCH", "02:00", None, None, None, None),
    ]
    made, _, _ = fab(spark, rows, [rule("sleuth_order", "last")])
    assert values(made) == {("R1", "5"): "1", ("R1", "7"): "1"}


def test_number_aggregates(spark):
    rows = [("V", "R1", "1", "CD", t, v) for t, v in (("1", 4.0), ("2", None), ("3", 2.0), ("4", None))]
    df = spark.createDataFrame(rows, "vehicle string, root_lot_id string, wafer_id string, item_id string, time string, value double")
    names = ["mean", "max", "min", "last", "first", "odd"]
    rules, skipped = features.number_rules([{"item_id": "CD", "agg": a} for a in names], "INLINE", Registry())
    got = {r["feature"]: r["value_num"] for r in features.number_features(df, rules, "item_id", "value", ["time"], Registry()).collect()}
    assert got == {"INLINE_CD_mean": 3.0, "INLINE_CD_max": 4.0, "INLINE_CD_min": 2.0, "INLINE_CD_last": None, "INLINE_CD_first": 4.0}
    assert len(skipped) == 1


def test_features_without_a_value_are_left_out(spark):
    rows = [("V", "R1", "1", "A", "FAB", " ", None), ("V", "R1", "1", "B", "FAB", "x", None), ("V", "R1", "1", "C", "VM", None, 0.0)]
    long = spark.createDataFrame(rows, "vehicle string, root_lot_id string, wafer_id string, feature string, category string, value_str string, value_num double")
    assert sorted(r["feature"] for r in features.with_values(long).collect()) == ["B", "C"]


@pytest.fixture(scope="module")
def hot(spark):
    """Groups of very different size: one holds a third of all rows."""
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        key = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{i % 40}"
        rows.append((key, rnd.randint(0, 400), rnd.choice([None, "", " a", "b", "b"]), f"{i:05d}"))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, n int, v string, o string").repartition(6)


def grouped(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def test_running_total_over_hot_groups(hot):
    rows, df = hot
    got = {(r["k"], r["o"]): (r["upto"], r["total"]) for r in running_total(df, ["k"], ["o"], F.col("n"), "upto").collect()}
    for key, group in grouped(rows).items():
        total = 0
        for r in sorted(group, key=lambda r: r[3]):
            total += r[1]
            assert got[(key, r[3])] == (total, sum(g[1] for g in group))


def test_dense_positions(hot):
    rows, df = hot
    got = {(r["k"], r["n"]): r["rank"] for r in dense_positions(df, ["k"], "n", "rank").collect()}
    for key, group in grouped(rows).items():
        for i, n in enumerate(sorted({r[1] for r in group})):
            assert got[(key, n)] == i + 1


def test_exact_order_statistics(hot):
    rows, df = hot
    medians = {r["k"]: r["m"] for r in exact_median(df, ["k"], "n", "m").collect()}
    ranks = {r["k"]: (r["p50"], r["p95"]) for r in nearest_ranks(df, ["k"], "n", {"p50": 0.5, "p95": 0.95}).collect()}
    for key, group in grouped(rows).items():
        ns = sorted(r[1] for r in group)
        last = len(ns) - 1
        assert medians[key] == (ns[last // 2] + ns[(last + 1) // 2]) / 2
        assert ranks[key] == (ns[round(0.5 * last)], ns[round(0.95 * last)])


def _ranks(values, wanted):
    values = sorted(values)
    return tuple(values[round(p * (len(values) - 1))] for p in wanted)


def test_ranks_by_histogram(spark):
    """Outliers by many powers, ties, a constant and a single-row group, nulls, infinities; long, double and date."""
    rnd = random.Random(3)
    rows = [("hot", rnd.choice([rnd.gauss(0, 1), rnd.gauss(0, 1) * 10 ** rnd.randint(0, 200), 5.0])) for _ in range(20000)]
    rows += [("same", 7.0)] * 3000 + [("one", -1.5), ("none", None), (None, 2.0), (None, 4.0), (None, None), ("inf", float("inf")), ("inf", float("-inf")), ("inf", 0.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: tuple(r[p] for p in wanted) for r in nearest_ranks(df, ["k"], "v", wanted).collect()}
    assert got == {k: _ranks([v for _, v in g if v is not None], wanted.values()) for k, g in grouped(rows).items() if k != "none"}
    whole = nearest_ranks(df, [], "v", wanted).collect()
    assert [tuple(r) for r in whole] == [_ranks([v for _, v in rows if v is not None], wanted.values())]
    longs = [2**62 + i * i for i in range(4000)]
    got = nearest_ranks(spark.createDataFrame([("a", n) for n in longs], "k string, v long"), ["k"], "v", wanted).first()
    assert tuple(got)[1:] == _ranks(longs, wanted.values())
    days = spark.range(3000).selectExpr("'a' AS k", "date_add(date'2026-01-01', cast(id AS int)) AS v")
    assert str(nearest_ranks(days, ["k"], "v", {"p50": 0.5}).first()["p50"]) == "2030-02-09"
    texts = spark.createDataFrame([("a", c) for c in "dbcae"], "k string, v string")
    assert nearest_ranks(texts, ["k"], "v", {"p50": 0.5}).first()["p50"] == "c"
    assert nearest_ranks(df.where("false"), ["k"], "v", wanted).collect() == []


def test_ranks_outside_their_bracket_are_still_exact(hot, monkeypatch):
    """A histogram that is wrong for some groups costs a sort of these groups, not the result."""
    rows, df = hot
    real = ranking._brackets

    def wrong(rows, keys, positions):
        moved = F.transform("_ranks", lambda r: F.struct(r["name"].alias("name"), r["position"].alias("position"), F.lit(399).alias("low"), r["high"].alias("high")))
        return real(rows, keys, positions).withColumn("_ranks", F.when(F.col("k").isin("hot", "k1"), moved).otherwise(F.col("_ranks")))

    monkeypatch.setattr(ranking, "_brackets", wrong)
    got = {r["k"]: (r["p50"], r["p95"]) for r in nearest_ranks(df, ["k"], "n", {"p50": 0.5, "p95": 0.95}).collect()}
    assert got == {k: _ranks([r[1] for r in g], (0.5, 0.95)) for k, g in grouped(rows).items()}


def test_a_histogram_shuffles_counts_only(hot):
    """Each value is its own in 30,000 rows; what is counted beside the rows below is a few steps of a thousand."""
    _, df = hot
    rows = df.sparkSession.range(30000).selectExpr("'a' AS k", "cast(id AS double) AS _value")
    bounds = ranking._brackets(rows, ["k"], {"p": F.expr("(total + 1) div 2")}).first()["_ranks"][0]
    assert bounds["low"] < 14999 <= bounds["high"] and bounds["high"] - bounds["low"] < 30000 * 5 / ranking.STEPS


def test_joins_over_hot_groups(hot):
    rows, df = hot
    ordered = {r["k"]: r["t"] for r in aggregates.ordered_join(df, ["k"], F.col("v"), ["o"], "t").collect()}
    distinct = {r["k"]: r["t"] for r in aggregates.distinct_join(df, ["k"], F.col("v"), "t").collect()}
    for key, group in grouped(rows).items():
        group = sorted(group, key=lambda r: r[3])
        assert ordered[key] == "_".join(r[2].strip() for r in group if r[2] is not None)
        assert distinct[key] == "_".join(sorted({r[2] for r in group if r[2] is not None}))


def test_conditions_on_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    ops = {"eq": [True, False], "neq": [False, False], "contains": [True, False], "in": [True, False],
           "not_in": [False, False], "_null": [False, True], "not_null": [True, False], "odd": [True, True]}
    rows = df.select(*[condition(op, "a", "v").alias(op) for op in ops]).collect()
    assert {op: [r[op] for r in rows] for op in ops} == ops


def test_check_filters(spark):
    df = spark.createDataFrame([(" Abc ",), ("",), (None,), ("xbz",)], "v string")
    expected = {"eq ABC": 1, "NOT NULL": 2, "null": 2, "startswith ab": 1, "contains b": 2, "": 4, None: 4, "odd": 4}
    assert {c: df.where(check_filter("v", c)).count() for c in expected} == expected


def test_globs(spark):
    df = spark.createDataFrame([("MEA-1",), ("mea-1",), ("A[1]",), ("A1",), ("AB\nC",), (None,)], "v string")
    def hits(p):
        return [r["v"] for r in df.where(F.col("v").rlike(glob_regex(p))).collect()]
    assert hits("MEA-*") == ["MEA-1"]
    assert hits("A[0-9]") == ["A1"]
    assert hits("A[!0-9]*") == ["A[1]", "AB\nC"]
    assert hits("A[[]1]") == ["A[1]"]
    reasons = [r[0] for r in df.select(first_glob("v", ["*-1", "MEA*"])).collect()]
    assert reasons == ["*-1", "*-1", None, None, None, None]
    assert [r[0] for r in df.select(matches_any_glob("v", ["A*"])).collect()] == [False, False, True, True, True, False]


def test_cleaning(spark):
    df = spark.createDataFrame([(" - ",), ("",), (" x ",), (None,), ("W07",), ("no",)], "v string")
    assert [r[0] for r in df.select(clean_dash("v")).collect()] == [None, None, "x", None, "W07", "no"]
    assert [r[0] for r in df.select(wafer_number("v")).collect()] == [None, None, None, None, 7, None]


def test_ordered_aggregate_order_is_shared():
    assert ORDER == ["tkout_time", "arrival"] and WAFER[0] == "vehicle"


def test_ordered_text_over_many_pieces(spark):
    """Hot, null and empty groups, nulls among the values, and batches that end within a group."""
    rows = [("hot", i, f"v{i} ") for i in range(5000)] + [(None, i, f"n{i}" if i % 3 else None) for i in range(50)]
    rows += [("empty", 1, None), ("one", 1, " x "), ("hot2", 2, None), ("hot2", 1, "a")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {r["k"]: r["t"] for r in aggregates.ordered_join(df, ["k"], F.col("v"), ["o"], "t").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {"hot": "_".join(f"v{i}" for i in range(5000)), None: "_".join(f"n{i}" for i in range(50) if i % 3), "empty": "", "one": "x", "hot2": "a"}
    assert aggregates.ordered_join(df.where("false"), ["k"], F.col("v"), ["o"], "t").collect() == []
