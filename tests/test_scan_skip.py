"""Scans, knob maps, skipped steps and the rule engine on hand-built rows."""

import pytest
from pyspark.sql import functions as F

from waferline.functions.registry import Registry
from waferline.operators import knob, rule_engine, scan, skip

DATA = [
    ("V", "CC100", "R001", "1", "PP_A1", "E01", "ETCH", "GEN-1"),
    ("V", "CC100", "R001", "2", "PP_NEW", "E01", "ETCH", "GEN-1"),
    ("V", "CC100", "R002", "1", "PP_A1", "E02", "ETCH", "GEN-1"),
    ("V", "CC200", "R001", "1", "PP_B1", "E01", "CVD", "GEN-1"),
    ("V", "CC999", "R003", "1", "PP_X", "E03", "MAIN", "GEN-1"),
    ("V", "CC999", "R004", "1", "PP_X", "E04", "MAIN", "GEN-1"),
]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(DATA, "vehicle string, step_id string, root_lot_id string, wafer_id string, ppid string, eqp_id string, step_desc string, eqp_model string")


@pytest.fixture(scope="module")
def steps(spark):
    return spark.createDataFrame([("V", "CC100", "ETCH"), ("V", "CC200", "CVD"), ("V", "CC300", "X")], "vehicle string, step_id string, step_desc string")


def test_missing_steps_and_recipes(spark, data, steps):
    missing = scan.missing_steps(data, steps, ["vehicle", "step_id"], 10).collect()
    assert [(r["step_id"], r["n_lots"], r["hits"]) for r in missing] == [("CC999", 2, "R003:1,R004:1")]
    known = spark.createDataFrame([("V", "CC100", "PP_A1"), ("V", "CC100", "PP_A2"), ("V", "CC200", "PP_B1")], "vehicle string, step_id string, ppid string")
    recipes = scan.unmatched_recipes(data, known, 10).collect()
    assert [(r["step_id"], r["ppid"], r["existing"], r["hits"]) for r in recipes] == [("CC100", "PP_NEW", "PP_A1,PP_A2", "R001:2")]


def test_ignored_keys(spark, data):
    ignored = spark.createDataFrame([("step", "CC999"), ("ppid", "CC100:PP_NEW")], "type string, key string")
    assert scan.without_ignored(data, ignored, "step").where("step_id = 'CC999'").isEmpty()
    assert scan.without_ignored(data, ignored, "ppid").count() == 5


def test_main_step_filter(spark, data):
    assert scan.main_steps_only(data, ["MA*"], []).count() == 4
    assert scan.main_steps_only(data.drop("step_desc"), ["MA*"], []).count() == 6
    nulls = data.selectExpr("cast(NULL AS string) AS step_desc", "eqp_model")
    assert scan.main_steps_only(nulls, ["*"], ["MEA-*"]).count() == 6
    assert scan.equipment_only(data, "eqp_id", ["E01"]).count() == 3 and scan.equipment_only(data, "eqp_id", []).count() == 6


def test_hint_settings_are_bounded():
    assert scan.hint_settings({"days": 999, "neighbors": 0, "value_limit": "x", "example_limit": -3}) == {
        "days": 90, "neighbors": 3, "value_limit": 12, "example_limit": 1}


def test_neighbors_share_prefix_and_width(spark):
    stats = spark.createDataFrame([("V", s, 1, 1) for s in ("AA104", "AA100", "AA102", "AA106", "AA1000", "BB103", "AA105", "AUX")],
                                  "vehicle string, step_id string, n_rows long, n_lots long")
    known = spark.createDataFrame([("V", s, "D") for s in ("AA100", "AA102", "AA106", "AA1000", "BB103")], "vehicle string, step_id string, step_desc string")
    got = {(r["step_id"], r["neighbor"], r["direction"], r["gap"]) for r in scan.neighbors(stats, known, 1).collect()}
    assert got == {("AA104", "AA102", "prev", 2), ("AA104", "AA106", "next", 2), ("AA105", "AA102", "prev", 3), ("AA105", "AA106", "next", 1)}


def test_examples_prefer_other_lots(spark):
    rows = [("S", "L1", "1", 1), ("S", "L1", "2", 2), ("S", "L1", "3", 3), ("S", "L2", "1", 4), ("S", "L1", "1", 5)]
    df = spark.createDataFrame(rows, "step_id string, root_lot_id string, wafer_id string, at int")
    got = [(r["root_lot_id"], r["wafer_id"]) for r in scan.step_examples(df, ["step_id"], ["at"], 3).orderBy("rank").collect()]
    assert got == [("L1", "1"), ("L2", "1"), ("L1", "2")]


def test_examples_see_lots_after_many_pairs_of_one(spark):
    rows = [("S", "L1", str(i), i) for i in range(60)] + [("S", "L2", "1", 60), ("S", "L3", "1", 61)]
    df = spark.createDataFrame(rows, "step_id string, root_lot_id string, wafer_id string, at int")
    got = [r["root_lot_id"] for r in scan.step_examples(df, ["step_id"], ["at"], 3).orderBy("rank").collect()]
    assert got == ["L1", "L2", "L3"]


# ── knob rules and skipped steps ──

RULE = [*knob.RULE_COLUMNS, "pos"]


def rules(spark, rows):
    full = [(*r, None, None, i) if len(r) == 6 else (*r, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in knob.RULE_COLUMNS) + ", pos int")


def event(spark, rows):
    """Rows of (wafer, step_id, step_desc, time, recipe) of one lot and vehicle."""
    full = [("V", "R1", w, s, d, t, f"{i:04d}", p, "s1") for i, (w, s, d, t, p) in enumerate(rows)]
    return spark.createDataFrame(full, "vehicle string, root_lot_id string, wafer_id string, step_id string, step_desc string, tkout_time string, arrival string, ppid string, split string")


def test_rule_map_first_match_and_blocks(spark):
    table = rules(spark, [
        ("F", "ETCH", "R2", "eq", "P1", "LATE"), ("F", "ETCH", "R1", "eq", "P1", "EARLY"), ("F", "ETCH", "RO", "eq", "P9", "NO"),
        ("G", "ETCH", "R1", "eq", "P2", "IN_BLOCK"), ("G", "CVD", "R1", "not_null", "", "IN_BLOCK"),
        ("H", "ETCH", "R3", "eq", "P3", "OFF", "N", None), ("H", "ETCH", "", "eq", "P4", "NO_NUMBER", "y", "first"),
    ])
    smap = spark.createDataFrame([("V", "S1", "ETCH")], "vehicle string, step_id string, step_desc string")
    got = {r["ppid"]: (r["knob"], r["rule_num"]) for r in knob.map_from_rules(table, smap).collect()}
    assert got == {"P1": ("EARLY", 1), "P4": ("NO_NUMBER", 1_000_000)}
    assert knob.mapped_steps(knob.map_from_rules(table, smap)).first()["agg"] == "first"
    blocks = {(r["feature"], r["step"], r["category"], r["n_conds"]) for r in knob.block_conditions(table).collect()}
    assert blocks == {("G", "ETCH", "IN_BLOCK", 2), ("G", "CVD", "IN_BLOCK", 2)}


def test_later_step_of_a_shared_description_wins(spark):
    pairs = spark.createDataFrame([("V", "S1", "ETCH", "P1", "K1", None, 0), ("V", "S2", "ETCH", "P2", "K2", None, 1), ("V", "S3", "ETCH", "P3", "K3", None, 2)],
                                  "vehicle string, step_id string, step_desc string, ppid string, knob string, agg string, pos int")
    rows = event(spark, [("1", "S1", "ETCH", "01", "P1"), ("1", "S2", "ETCH", "02", "P2"), ("2", "S1", "ETCH", "01", "P1"), ("3", "S2", "ETCH", "01", "P9")])
    looked_up = knob.lookup(rows, knob.map_from_pairs(pairs))
    got = {r["wafer_id"]: r["value_str"] for r in knob.features(looked_up, Registry(), ["last"]).collect()}
    assert got == {"1": "K2", "3": "P9"}  # wafer 2 passed only the earlier step
    # but it passed one of the steps, so it did not skip
    steps = spark.createDataFrame([("V", "KNOB_ETCH_ppid", s) for s in ("S1", "S2")], FEATURE_STEPS)
    assert skip.candidates(skip.last_per_step(rows), steps).isEmpty()


def test_knob_aggregates(spark):
    registry = Registry()
    registry.register_agg("longest", lambda val, order: F.max_by(val, F.length(val)))
    maps = [("S1", "ETCH", " concat "), ("S2", "CVD", None), ("S3", "CMP", "agg"), ("S4", "CLEAN", "longest"), ("S5", "IMP", "nonsense")]
    pairs = spark.createDataFrame([("V", s, d, "P1", "K1", a, i) for i, (s, d, a) in enumerate(maps)],
                                  "vehicle string, step_id string, step_desc string, ppid string, knob string, agg string, pos int")
    rows = event(spark, [("1", s, d, t, p) for s, d, _ in maps for t, p in (("01", "P1"), ("02", "P20"), ("03", "P1"))])
    aggs, skipped = knob.aggregates_used([{"step_desc": d, "agg": a} for _, d, a in maps], registry)
    assert aggs == ["agg", "concat", "last", "longest"]
    assert skipped == [{"feature": "KNOB_IMP_ppid", "reason": "unknown aggregate nonsense"}]
    found = knob.features(knob.lookup(rows, knob.map_from_pairs(pairs)), registry, aggs)
    got = {r["feature"][5:-5]: r["value_str"] for r in found.collect()}
    assert got == {"ETCH": "K1_P20_K1", "CVD": "K1", "CMP": "K1_P20", "CLEAN": "P20"}


def test_skip_by_rule(spark):
    table = rules(spark, [("F", "ETCH", "R1", "eq", "P1", "A"), ("F", "ETCH", "R9", "_null", "", "SKIP"), ("F", "CVD", "R9", "not_null", "", "SKIP"),
                          ("G", "ETCH", "R9", "not_null", "", "SKIP"), ("G", "GONE", "R9", "_null", "", "SKIP"),
                          ("H", "ETCH", "R1", "in", "a|b", "VALUE")])
    rows = event(spark, [("1", "S1", "ETCH", "01", "P1"), ("2", "S2", "CVD", "02", "PX"), ("3", "S2", "CVD", "02", None), ("4", "S3", "PHOTO", "01", "PX")])
    last = skip.last_per_step(rows)
    conditions, targets = knob.block_conditions(table), knob.block_targets(table)
    known = spark.createDataFrame([("V", d) for d in ("ETCH", "CVD", "PHOTO")], "vehicle string, name string")
    blocks, aims, refused = skip.usable_blocks(conditions, targets, known, ["V"])
    assert {r["block"] for r in blocks.collect()} == {"F/R9"}
    assert sorted(r["reason"] for r in refused.collect()) == ["only SKIP blocks are supported", "unknown step GONE"]
    missing = skip.candidates(last, spark.createDataFrame([("V", "KNOB_ETCH_ppid", "S1")], FEATURE_STEPS))
    assert sorted(r["wafer_id"] for r in missing.collect()) == ["2", "3", "4"]
    assert [(r["wafer_id"], r["rule"]) for r in skip.by_rule(last, missing, blocks, aims).collect()] == [("2", "F/R9")]
    assert [r["feature"] for r in skip.targeted(conditions, targets).collect()] == ["KNOB_ETCH_ppid"]


FEATURE_STEPS = "vehicle string, feature string, step_id string"


def test_every_condition_of_a_block_counts(spark):
    """Blocks of all operators, against the conditions tried one by one."""
    from waferline.functions.conditions import condition

    ops = [("eq", "P1"), ("neq", "P1"), ("contains", "^P"), ("in", "P1|P2"), ("not_in", "P1|P2"), ("_null", ""), ("not_null", ""), ("odd", "")]
    wafers = {"1": ("P1", "P2"), "2": ("P3", None), "3": (None, "P1"), "4": ("Q", "P3")}
    rows = event(spark, [(w, s, d, "01", p) for w, both in wafers.items() for s, d, p in (("S1", "ETCH", both[0]), ("S2", "CVD", both[1])) if p])
    rows = rows.unionByName(event(spark, [(w, "S3", "PHOTO", "01", "PX") for w in wafers]))
    last = skip.last_per_step(rows)
    missing = skip.candidates(last, spark.createDataFrame([("V", "F", "S9")], FEATURE_STEPS))
    blocks = [(f"{a[0]}&{b[0]}", a, b) for a in ops for b in ops]
    conditions = spark.createDataFrame([("V", name, step, *c) for name, a, b in blocks for step, c in (("ETCH", a), ("S2", b))], "vehicle string, block string, step string, op string, value string")
    aims = spark.createDataFrame([("V", name, i, name, 2, "F") for i, (name, _, _) in enumerate(blocks)], "vehicle string, block string, first int, rule string, n_conds int, feature string")
    values = spark.createDataFrame([(w, *p) for w, p in wafers.items()], "w string, a string, b string")
    for number, (name, a, b) in enumerate(blocks):
        if number % 5:
            continue
        one = aims.where(F.col("block") == name)
        got = {r["wafer_id"] for r in skip.by_rule(last, missing, conditions.where(F.col("block") == name), one).collect()}
        assert got == {r["w"] for r in values.where(condition(*a, "a") & condition(*b, "b")).collect()}, name
    every = {r["wafer_id"]: r["rule"] for r in skip.by_rule(last, missing, conditions, aims).collect()}
    assert every["1"] == "eq&neq" and every["2"] == "neq&_null"


def test_skip_by_order(spark):
    rows = []
    for w in range(6):
        rows += [(str(w), "S1", "ETCH", "01", "P"), (str(w), "S2", "CVD", "02", "P"), (str(w), "S0", "WELL", "00", "P")]
    rows += [("late", "S2", "CVD", "02", "P"), ("pending", "S0", "WELL", "00", "P")]
    last = skip.last_per_step(event(spark, rows))
    steps = spark.createDataFrame([("V", "F_MID", "S1"), ("V", "F_END", "S2")], FEATURE_STEPS)
    stats = skip.copassage(last, steps)
    found = {(r["feature"], r["step_id"]) for r in skip.anchors(stats).collect()}
    assert found == {("F_MID", "S2")}  # the last step of the route has no anchor
    skipped = skip.by_order(last, skip.candidates(last, steps), skip.anchors(stats))
    assert [(r["wafer_id"], r["feature"]) for r in skipped.collect()] == [("late", "F_MID")]
    assert skip.anchors(stats, min_support=7).isEmpty()


def engine(spark, matrix, rows):
    keys = ["feature_name", "step_desc", "rule_order", "operator", "value", "category"]
    return rule_engine.evaluate(matrix, [dict(zip(keys, r)) for r in rows])


def test_engine_order_fallback_and_depth(spark):
    matrix = spark.createDataFrame([("1", "P1", "Q1"), ("2", "P2", None), ("3", None, None)], "wafer_id string, Etch_PPID string, Cvd_PPID string")
    out = engine(spark, matrix, [
        ("knob", "etch", "R10", "not_null", None, "LATE"), ("knob", "etch", "R2", "eq", "P1", "TWO"), ("knob", "cvd", "R2", "eq", "Q1", "TWO"),
        ("knob", "etch", "RO", None, None, None), ("knob", "cvd", "RO", None, None, None),
        ("child", "KNOB", "R1", "eq", "TWO", "C2"), ("child", "nowhere", "RO", None, None, "STD"),
    ])
    assert [tuple(r) for r in out.select("WAFER_ID", "KNOB", "CHILD").orderBy("WAFER_ID").collect()] == [
        ("1", "TWO", "C2"), ("2", "LATE", "STD"), ("3", "None_None", "STD")]


def test_engine_refuses_cycles():
    rows = [{"feature_name": "A", "step_desc": "B_X"}, {"feature_name": "B", "step_desc": "A"}]
    with pytest.raises(ValueError):
        rule_engine.depths([{**r, "rule_order": "R1"} for r in rows])


def test_nearest_steps_equal_all_pairs(spark):
    import random

    rng = random.Random(5)
    ids = sorted({f"{rng.choice(['AA', 'B'])}{rng.randint(0, 60):0{rng.choice([2, 3])}d}" for _ in range(120)} | {"NONUM"})
    stats = [(v, s, 1, 1) for v in ("V", "W") for s in ids]
    known = [(v, s, f"D{s}") for v, s, *_ in stats if rng.random() < 0.4] + [("V", "AA999", "unseen")]
    got = scan.neighbors(spark.createDataFrame(stats, "vehicle string, step_id string, n_rows long, n_lots long"),
                         spark.createDataFrame(known, "vehicle string, step_id string, step_desc string"), 2)
    got = sorted((r["vehicle"], r["step_id"], r["neighbor"], r["direction"], r["gap"]) for r in got.collect())
    seen, want = {(v, s) for v, s, *_ in stats}, []
    split = lambda s: (s.rstrip("0123456789"), len(s) - len(s.rstrip("0123456789")))
    for v, s, *_ in stats:
        if (v, s) in {k[:2] for k in known} or s == "NONUM":
            continue
        number = int(s[len(split(s)[0]):])
        others = [(int(o[len(split(o)[0]):]), o) for w, o, _ in known if w == v and (w, o) in seen and split(o) == split(s)] if split(s)[1] else []
        for direction, near in (("prev", sorted((x for x in others if x[0] < number), reverse=True)[:2]), ("next", sorted(x for x in others if x[0] > number)[:2])):
            want += [(v, s, o, direction, abs(n - number)) for n, o in near]
    assert got == sorted(want) and len(want) > 60


def test_hints_carry_the_neighbours_values(spark):
    rows = [("V", "CC100", "R1", "P1", "E1", 1), ("V", "CC150", "R1", "P1", None, 2), ("V", "CC150", "R2", "P2", "E3", 3), ("V", "CC200", "R1", "P9", "E9", 4), ("V", "XX1", "R1", "P", "E", 5)]
    data = spark.createDataFrame(rows, "vehicle string, step_id string, root_lot_id string, ppid string, eqp_id string, o int")
    steps = spark.createDataFrame([("V", "CC100", "ETCH"), ("V", "CC200", "CVD")], "vehicle string, step_id string, step_desc string")
    wanted = spark.createDataFrame([("V", "CC150"), ("V", "XX1"), ("V", "CC170")], "vehicle string, step_id string")
    got = {r["step_id"]: r for r in scan.hints(data, wanted, steps, ["ppid", "eqp_id"], ["o"], scan.hint_settings({})).collect()}
    assert got["CC150"]["n_rows"] == 2 and got["CC150"]["n_lots"] == 2 and got["CC150"]["values"] == {"ppid": ["P1", "P2"], "eqp_id": ["E3"]}
    near = got["CC150"]["neighbors"]
    assert [(n["step_id"], n["step_desc"], n["direction"], n["gap"], n["values"]["ppid"]) for n in near] == [("CC100", "ETCH", "prev", 50, ["P1"]), ("CC200", "CVD", "next", 50, ["P9"])]
    assert got["XX1"]["neighbors"] == [] and got["CC170"]["n_rows"] == 0 and len(got["CC170"]["neighbors"]) == 2 and got["CC170"]["values"] == {}
