"""Queries over rule tables, knob features, skipped steps and the rule engine."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.operators import alerts, knob, rule_engine, skip
from waferline.operators.features import WAFER
from waferline.plans import bindings, common, rulebook
from waferline.plans.common import FAB_EVENT, KNOB_FEATURE, KNOB_LOOKUP, last_sql
from waferline.plans.features import _LAST_PER_STEP, _MATRIX, recipe_matrix
from waferline.plans.registry import query
from waferline.session import cut_lineage
from waferline.sources import rules as rule_tables

_RULES = "WITH " + bindings.cte("part_rules")
_USE = "upper(trim(coalesce(\"use\", ''))) IN ('', 'Y', '1', 'TRUE')"


@query("rule_block_size", f"""{_RULES} SELECT feature_name, rule_order, function_step, pos,
    count(*) OVER (PARTITION BY feature_name, rule_order) AS block_rows FROM part_rules""")
def rule_block_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = knob.block_sizes(bindings.bound(spark, sf_dir, "part_rules"))
    return sized.select("feature_name", "rule_order", "function_step", "pos", "block_rows")


@query("knob_map", f"""{_RULES}, {bindings.cte('part_steps')}, single AS (
      SELECT *, count(*) OVER (PARTITION BY feature_name, rule_order) AS block_rows,
        coalesce(try_cast(nullif(regexp_extract(rule_order, '(\\d+)', 1), '') AS bigint), 1000000) AS rule_num FROM part_rules)
    SELECT s.vehicle, s.step_id, s.step_desc, r.value AS ppid, r.category AS knob, r.rule_num
    FROM (SELECT DISTINCT * FROM part_steps) s JOIN single r ON s.step_desc = trim(r.function_step)
    WHERE block_rows = 1 AND {_USE} AND trim(coalesce(operator, '')) = 'eq' AND upper(trim(rule_order)) <> 'RO'
      AND trim(coalesce(value, '')) <> '' AND trim(coalesce(category, '')) <> ''
    QUALIFY row_number() OVER (PARTITION BY s.vehicle, s.step_id, r.value ORDER BY r.rule_num, r.pos) = 1""")
def knob_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = knob.map_from_rules(
        bindings.bound(spark, sf_dir, "part_rules"), bindings.bound(spark, sf_dir, "part_steps")
    )
    return found.drop("agg", "pos")


_PREPARED = f"""prepared AS (SELECT trim(coalesce(feature_name, '')) AS feature, trim(coalesce(function_step, '')) AS step,
      upper(trim(coalesce(rule_order, ''))) AS rule_order, trim(coalesce(operator, '')) AS op, trim(coalesce(value, '')) AS value,
      trim(coalesce(category, '')) AS category, pos FROM part_rules WHERE {_USE})"""


@query("rule_blocks", f"""{_RULES}, {_PREPARED}, sized AS (
      SELECT *, count(*) OVER block AS n_conds,
        coalesce(first(CASE WHEN category <> '' THEN category END ORDER BY (category = ''), pos) OVER block, '') AS block_category
      FROM prepared WHERE rule_order <> 'RO' WINDOW block AS (PARTITION BY feature, rule_order))
    SELECT feature, rule_order, step, op, value, pos, n_conds, block_category AS category FROM sized WHERE n_conds > 1 OR op <> 'eq'""")
def rule_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knob.block_conditions(bindings.bound(spark, sf_dir, "part_rules"))


@query("rule_block_targets", f"""{_RULES}, {_PREPARED} SELECT DISTINCT feature, step FROM prepared WHERE step <> '' AND
    (rule_order = 'RO' OR (regexp_matches(rule_order, '^R\\d+$') AND op = 'eq' AND category <> '' AND upper(category) <> 'SKIP'))""")
def rule_block_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knob.block_targets(bindings.bound(spark, sf_dir, "part_rules"))


@query("map_conflicts", """WITH pairs AS (SELECT DISTINCT concat('ST', cast(p_size AS varchar)) AS step_id, p_brand AS step_desc FROM part)
    SELECT step_id, count(*) AS n_descs, array_to_string(list(step_desc ORDER BY step_desc)[1:10], ',') AS descs FROM pairs GROUP BY step_id HAVING count(*) > 1""")
def map_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = bindings.table(spark, sf_dir, "part")
    steps = part.selectExpr("concat('ST', cast(p_size AS string), ' ') AS step_id", "p_brand AS step_desc")
    return rule_tables.conflicts(steps, ["step_id"])


def looked_up(spark: SparkSession, sf_dir: str, event: DataFrame | None = None) -> DataFrame:
    event = common.fab_event(spark, sf_dir) if event is None else event
    return knob.lookup(event, knob.map_from_rules(bindings.rules(spark, "knob_rules"), common.step_map(spark)))


@query("knob_lookup", f"WITH {FAB_EVENT}, {KNOB_LOOKUP} SELECT arrival, wafer_id, step_id, ppid, knob FROM looked_up")
def knob_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return looked_up(spark, sf_dir).select("arrival", "wafer_id", "step_id", "ppid", "knob")


@query("knob_pairs_lookup", f"""WITH {FAB_EVENT}, {bindings.cte('knob_pairs')}, last_pairs AS (
      SELECT vehicle, step_id, ppid, last(knob ORDER BY pos) AS knob FROM knob_pairs GROUP BY ALL)
    SELECT arrival, wafer_id, step_id, e.ppid, knob FROM event e LEFT JOIN last_pairs p USING (vehicle, step_id, ppid)
    WHERE (vehicle, step_id) IN (SELECT (vehicle, step_id) FROM knob_pairs)""")
def knob_pairs_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = knob.map_from_pairs(bindings.rules(spark, "knob_pairs"))
    return knob.lookup(common.fab_event(spark, sf_dir), pairs).select("arrival", "wafer_id", "step_id", "ppid", "knob")


@query("knob_miss", f"""WITH {FAB_EVENT}, {KNOB_LOOKUP}, missed AS (
      SELECT vehicle, split, step_id, knob_desc AS step_desc, coalesce(ppid, '') AS ppid, root_lot_id, wafer_id FROM looked_up WHERE knob IS NULL)
    SELECT vehicle, split, step_id, step_desc, ppid, count(DISTINCT root_lot_id) AS n_lots, count(DISTINCT wafer_id) AS n_wafers,
      array_to_string(list(DISTINCT root_lot_id ORDER BY root_lot_id)[1:5], ',') AS lots FROM missed GROUP BY ALL""")
def knob_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knob.misses(looked_up(spark, sf_dir))


@query("alert_miss_rollup", f"""WITH {FAB_EVENT}, {KNOB_LOOKUP}, missed AS (
      SELECT vehicle, split, step_id, knob_desc AS step_desc, coalesce(ppid, '') AS ppid, count(DISTINCT root_lot_id) AS n_lots, count(DISTINCT wafer_id) AS n_wafers
      FROM looked_up WHERE knob IS NULL GROUP BY ALL)
    SELECT concat_ws('|', 'ro', vehicle, step_id, ppid) AS id, vehicle, step_id, ppid, min(step_desc) AS step_desc,
      string_agg(DISTINCT split, ', ' ORDER BY split) AS split, sum(n_lots)::bigint AS n_lots, sum(n_wafers)::bigint AS n_rows FROM missed GROUP BY vehicle, step_id, ppid""")
def alert_miss_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.roll_up_misses(cut_lineage(knob.misses(looked_up(spark, sf_dir))))  # read twice


def knob_values(rows: DataFrame) -> DataFrame:
    aggs, _ = knob.aggregates_used(rulebook.dicts("knob_rules"), common.REGISTRY)
    return knob.features(rows, common.REGISTRY, aggs)


@query("knob_feature", f"WITH {FAB_EVENT}, {KNOB_FEATURE} SELECT * FROM knob_feature")
def knob_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knob_values(looked_up(spark, sf_dir))


# ── skipped steps ──

_LPS = f"""lps AS ({_LAST_PER_STEP}),
  kf AS (SELECT DISTINCT vehicle, concat('KNOB_', knob_desc, '_ppid') AS feature, step_id FROM looked_up),
  missing AS (
    SELECT u.vehicle, root_lot_id, wafer_id, feature FROM (SELECT DISTINCT vehicle, root_lot_id, wafer_id FROM event) u
      JOIN (SELECT DISTINCT vehicle, feature FROM kf) f ON u.vehicle = f.vehicle
    EXCEPT SELECT l.vehicle, root_lot_id, wafer_id, feature FROM lps l JOIN kf ON l.vehicle = kf.vehicle AND l.step_id = kf.step_id)"""
_AUTO = ("KNOB_GATE_ETCH_ppid", "KNOB_METAL_ETCH_ppid", "KNOB_WELL_IMPLANT_ppid")
_STATS = f"""refs AS (SELECT l.vehicle, root_lot_id, wafer_id, feature, max(t) AS t_ref FROM lps l JOIN kf ON l.vehicle = kf.vehicle AND l.step_id = kf.step_id
      WHERE feature IN {_AUTO} GROUP BY ALL),
  stats AS (SELECT r.vehicle, r.feature, l.step_id, count(*) AS n, avg(CASE WHEN l.t > r.t_ref THEN 1.0 WHEN l.t <= r.t_ref THEN 0.0 END) AS share
    FROM lps l JOIN refs r USING (vehicle, root_lot_id, wafer_id)
    WHERE (r.vehicle, r.feature, l.step_id) NOT IN (SELECT (vehicle, feature, step_id) FROM kf) GROUP BY ALL),
  anchors AS (SELECT * FROM stats WHERE n >= 5 AND share >= 0.8)"""
_BY_RULE = """by_rule AS (SELECT m.*, 'FINAL/R9' AS rule FROM missing m WHERE feature = 'KNOB_FINAL_INSPECTION_ppid' AND EXISTS (
      SELECT 1 FROM lps l WHERE l.vehicle = m.vehicle AND l.root_lot_id = m.root_lot_id AND l.wafer_id = m.wafer_id
        AND l.step_desc = 'GATE_PHOTO' AND l.ppid IS NOT NULL))"""
_BY_ORDER = f"""by_order AS (SELECT m.* FROM missing m WHERE feature IN {_AUTO} AND EXISTS (
      SELECT 1 FROM lps l JOIN anchors a ON l.vehicle = a.vehicle AND l.step_id = a.step_id
      WHERE l.vehicle = m.vehicle AND l.root_lot_id = m.root_lot_id AND l.wafer_id = m.wafer_id AND a.feature = m.feature))"""
_SKIP = f"WITH {FAB_EVENT}, {KNOB_LOOKUP}, {_LPS}"


class SkipInputs:
    """What the skip layer needs, with one row per wafer and step written once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.event = common.fab_event(spark, sf_dir)
        self.last = cut_lineage(skip.last_per_step(self.event))
        present = self.last.select("vehicle", "step_id").distinct()
        steps = knob.mapped_steps(knob.map_from_rules(bindings.rules(spark, "knob_rules"), common.step_map(spark)))
        feature = F.concat(F.lit("KNOB_"), "step_desc", F.lit("_ppid")).alias("feature")
        self.steps = steps.select("vehicle", "step_id", feature).join(present, ["vehicle", "step_id"], "left_semi")
        self.present = present
        rules = bindings.rules(spark, "knob_rules")
        self.conditions, self.targets = knob.block_conditions(rules), knob.block_targets(rules)

    def missing(self) -> DataFrame:
        return skip.candidates(self.last, self.steps)

    def blocks(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        known = self.present.select("vehicle", F.col("step_id").alias("name"))
        known = known.unionByName(bindings.rules(self.spark, "step_map").select("vehicle", F.col("step_desc").alias("name")))
        return skip.usable_blocks(self.conditions, self.targets, known, list(rulebook.VEHICLES))

    def by_rule(self) -> DataFrame:
        conditions, aims, _ = self.blocks()
        return skip.by_rule(self.last, self.missing(), conditions, aims)

    def auto_steps(self) -> DataFrame:
        return self.steps.join(skip.targeted(self.conditions, self.targets), "feature", "left_anti")

    def stats(self) -> DataFrame:
        return skip.copassage(self.last, self.auto_steps())

    def by_order(self) -> DataFrame:
        missing = self.missing().join(skip.targeted(self.conditions, self.targets), "feature", "left_anti")
        return skip.by_order(self.last, missing, skip.anchors(self.stats()))


@query("skip_candidates", f"{_SKIP} SELECT * FROM missing")
def skip_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = SkipInputs(spark, sf_dir)
    return skip.without_value(inputs.missing(), knob_values(looked_up(spark, sf_dir, inputs.event)))


@query("skip_rule", f"{_SKIP}, {_BY_RULE} SELECT *, 'SKIP' AS value_str FROM by_rule")
def skip_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SkipInputs(spark, sf_dir).by_rule().withColumn("value_str", F.lit("SKIP"))


@query("skip_refused", f"""WITH {FAB_EVENT}, {bindings.cte('knob_rules')}, blocks AS (
      SELECT trim(feature_name) AS feature, upper(trim(coalesce(rule_order, ''))) AS rule_order, count(*) AS n, min(trim(coalesce(operator, ''))) AS any_op,
        arg_min(upper(trim(category)), pos) FILTER (WHERE trim(coalesce(category, '')) <> '') AS category
      FROM knob_rules WHERE upper(trim(coalesce("use", ''))) IN ('', 'Y', '1', 'TRUE') AND upper(trim(coalesce(rule_order, ''))) <> 'RO' GROUP BY ALL),
    known AS (SELECT vehicle, step_desc AS name FROM step_map UNION SELECT vehicle, step_id FROM event)
    SELECT v.vehicle, concat(b.feature, '/', b.rule_order) AS rule, concat('unknown step ', arg_min(trim(k.function_step), k.pos)) AS reason
    FROM blocks b JOIN knob_rules k ON trim(k.feature_name) = b.feature AND upper(trim(coalesce(k.rule_order, ''))) = b.rule_order
      CROSS JOIN (SELECT DISTINCT vehicle FROM step_map) v LEFT JOIN known ON known.vehicle = v.vehicle AND known.name = trim(k.function_step)
    WHERE (n > 1 OR any_op <> 'eq') AND b.category = 'SKIP' AND known.name IS NULL AND upper(trim(coalesce(k."use", ''))) IN ('', 'Y', '1', 'TRUE') GROUP BY ALL
    UNION ALL SELECT '' AS vehicle, concat(feature, '/', rule_order) AS rule, 'only SKIP blocks are supported' AS reason FROM blocks
    WHERE (n > 1 OR any_op <> 'eq') AND coalesce(category, '') <> 'SKIP'""")
def skip_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SkipInputs(spark, sf_dir).blocks()[2]


@query("copassage_stats", f"{_SKIP}, {_STATS} SELECT vehicle, feature, step_id, n, round(share, 6) AS share FROM stats")
def copassage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SkipInputs(spark, sf_dir).stats().withColumn("share", F.round("share", 6))


@query("skip_auto", f"{_SKIP}, {_STATS}, {_BY_ORDER} SELECT *, 'SKIP' AS value_str FROM by_order")
def skip_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SkipInputs(spark, sf_dir).by_order().withColumn("value_str", F.lit("SKIP"))


@query("skip_report", f"""{_SKIP}, {_STATS}, {_BY_RULE}, {_BY_ORDER}, skips AS (
      SELECT vehicle, root_lot_id, wafer_id, feature, 'rule' AS mode FROM by_rule UNION ALL SELECT *, 'auto' FROM by_order),
    splits AS (SELECT vehicle, root_lot_id, wafer_id, {last_sql('split', 'split IS NOT NULL')} AS split FROM event GROUP BY ALL)
    SELECT vehicle, coalesce(split, '') AS split, feature, mode, count(*) AS n_wafers, count(DISTINCT root_lot_id) AS n_lots,
      array_to_string(list(DISTINCT root_lot_id ORDER BY root_lot_id)[1:5], ',') AS lots
    FROM skips LEFT JOIN splits USING (vehicle, root_lot_id, wafer_id) GROUP BY ALL""")
def skip_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = SkipInputs(spark, sf_dir)
    skips = inputs.by_rule().select(*WAFER, "feature", F.lit("rule").alias("mode")).unionByName(
        inputs.by_order().select(*WAFER, "feature", F.lit("auto").alias("mode"))
    )
    skips = cut_lineage(skips)  # counted, and asked for example lots
    return skip.report(skips, skip.last_split(inputs.event))


# ── rule engine over the wafer matrix ──

_OXIDE = """CASE WHEN GATE_ETCH_PPID IN ('PP_N0', 'PP_N1') THEN 'PC_N'
      WHEN GATE_ETCH_PPID = 'PP_A0' AND SPACER_CVD_PPID IS NOT NULL THEN 'PC_A' ELSE {other} END"""
_WELL = """CASE WHEN regexp_matches(WELL_IMPLANT_PPID, '^PP_R') THEN 'WELL_R' WHEN WELL_IMPLANT_PPID <> 'PP_A0' THEN 'WELL_OTHER' ELSE {other} END"""
_SIGNATURE = "concat(coalesce(GATE_ETCH_PPID, 'None'), '_', coalesce(SPACER_CVD_PPID, 'None'))"
_COMBO = """CASE WHEN "OXIDE" = 'PC_N' THEN 'COMBO_N' WHEN "WELL" NOT IN ('WELL_STD', 'WELL_R') THEN 'COMBO_W' WHEN GATE_STACK_PPID IS NULL THEN 'COMBO_0' END"""
_ENGINE_KEY = 'vehicle AS "VEHICLE", root_lot_id AS "ROOT_LOT_ID", wafer_id AS "WAFER_ID"'


def _engine(spark: SparkSession, sf_dir: str, keep: list[str], fallback: bool) -> DataFrame:
    rules = [r for r in rulebook.engine_rules() if fallback or r["rule_order"] != "RO"]
    rules = [r for r in rules if r["feature_name"] in (["OXIDE", "WELL"] if "COMBO" not in keep else ["OXIDE", "WELL", "COMBO"])]
    out = rule_engine.evaluate(recipe_matrix(spark, sf_dir), rules)
    return out.select("VEHICLE", "ROOT_LOT_ID", "WAFER_ID", *keep)


@query("rule_engine", f"""WITH {FAB_EVENT}, {_MATRIX} SELECT {_ENGINE_KEY}, {_OXIDE.format(other='NULL')} AS "OXIDE", {_WELL.format(other='NULL')} AS "WELL" FROM matrix""")
def engine_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir, ["OXIDE", "WELL"], fallback=False)


@query("rule_engine_ro", f"""WITH {FAB_EVENT}, {_MATRIX} SELECT {_ENGINE_KEY}, {_OXIDE.format(other=_SIGNATURE)} AS "OXIDE", {_WELL.format(other="'WELL_STD'")} AS "WELL" FROM matrix""")
def engine_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir, ["OXIDE", "WELL"], fallback=True)


@query("rule_engine_depth", f"""WITH {FAB_EVENT}, {_MATRIX}, first_depth AS (
      SELECT *, {_OXIDE.format(other=_SIGNATURE)} AS "OXIDE", {_WELL.format(other="'WELL_STD'")} AS "WELL" FROM matrix)
    SELECT {_ENGINE_KEY}, {_COMBO} AS "COMBO" FROM first_depth""")
def engine_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir, ["COMBO"], fallback=True)
