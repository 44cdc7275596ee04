"""Queries over events, ordered aggregates and the long feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.functions import aggregates
from waferline.operators import event as events
from waferline.operators import features, history, skip
from waferline.operators.features import ORDER, WAFER
from waferline.plans import bindings, common, rulebook
from waferline.plans.common import (
    FAB_EVENT, INLINE_EVENT, LONG, SLEUTH, VALUE_SQL, VM_EVENT, agg_sql, last_sql, number_feature_sql,
    text_feature_sql,
)
from waferline.plans.registry import query
from waferline.session import cut_lineage

_EVENT_COLS = "arrival, vehicle, root_lot_id, wafer_id, part_id, tkout_time, step_id, step_desc, ppid, reticle_id, eqp_id, eqp_model, chamber_id, unit_id, sleuth_order, split"


@query("event_step_join", f"WITH {FAB_EVENT} SELECT arrival, vehicle, root_lot_id, wafer_id, step_id, step_desc FROM event")
def event_step_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw").where(F.col("root_lot_id").startswith(rulebook.LOT_PREFIX))
    joined = events.join_steps(raw, common.step_map(spark), common.STEP_KEYS)
    return joined.select("arrival", "vehicle", "root_lot_id", "wafer_id", "step_id", "step_desc")


@query("event_build", f"WITH {FAB_EVENT} SELECT {_EVENT_COLS} FROM event")
def event_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.fab_event(spark, sf_dir).drop("area")


@query("event_item_join", f"""WITH {bindings.cte('item_raw', 'item_rules')}
    SELECT vehicle, step_desc, item_id, subitem_id, count(*) AS n, min(fab_value) AS low, max(time) AS newest
    FROM item_raw JOIN item_rules USING (step_desc, item_id) GROUP BY ALL""")
def event_item_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bindings.bound(spark, sf_dir, "item_raw").join(bindings.rules(spark, "item_rules"), ["step_desc", "item_id"])
    return rows.groupBy("vehicle", "step_desc", "item_id", "subitem_id").agg(
        F.count("*").alias("n"), F.min("fab_value").alias("low"), F.max("time").alias("newest")
    )


_TOOL = VALUE_SQL["ecuall"]
_STEP_AGGS = {
    "agg_first": ("first", "ppid", "ppid"),
    "agg_last": ("last", "ppid", "ppid"),
    "agg_concat": ("concat", "ppid", "ppid"),
    "agg_last_valid": ("last_valid", "ppid", "ppid"),
    "agg_valid_eqp": ("valid_eqp", "ecuall", _TOOL),
    "agg_valid_or_last": ("valid_or_last", "ecuall", _TOOL),
    "agg_distinct_join": ("agg", "ppid", "ppid"),
}
_STEP_GROUP = [*WAFER, "step_id"]


def _step_aggregate(event: DataFrame, agg: str, value: str) -> DataFrame:
    spec = common.REGISTRY.text_agg(agg)
    rows = event.select(*_STEP_GROUP, *ORDER, common.REGISTRY.value(value).alias("val"))
    if spec.joins == "ordered":
        return aggregates.ordered_join(rows, _STEP_GROUP, F.col("val"), ORDER, "val")
    if spec.joins == "distinct":
        return aggregates.distinct_join(rows, _STEP_GROUP, F.col("val"), "val")
    out = rows.groupBy(*_STEP_GROUP).agg(spec.expr(F.col("val"), [F.col(c) for c in ORDER]).alias("val"))
    return out.where(F.col("val").isNotNull()) if spec.drops_null else out


def _step_query(name: str, agg: str, value: str, sql_value: str) -> None:
    keep = " HAVING val IS NOT NULL" if agg == "valid_eqp" else ""
    keys = ", ".join(_STEP_GROUP)

    @query(name, f"WITH {FAB_EVENT} SELECT {keys}, {agg_sql(agg, sql_value)} AS val FROM event GROUP BY {keys}{keep}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _step_aggregate(common.fab_event(spark, sf_dir), agg, value)


for _name, (_agg, _value, _sql) in _STEP_AGGS.items():
    _step_query(_name, _agg, _value, _sql)


@query("agg_valid_eqp_keepkey", f"WITH {FAB_EVENT} SELECT {', '.join(_STEP_GROUP)}, {agg_sql('valid_eqp', _TOOL)} AS val FROM event GROUP BY {', '.join(_STEP_GROUP)}")
def agg_valid_eqp_keepkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a site's own aggregate of a built-in's name wins, and keeps wafers without a valid tool
    from waferline.functions.registry import Registry

    own = Registry()
    own.register_agg("valid_eqp", aggregates.VALID_TOOL_FIRST.expr)
    rows = common.fab_event(spark, sf_dir).withColumn("val", own.value("ecuall"))
    expr = own.text_agg("valid_eqp").expr(F.col("val"), [F.col(c) for c in ORDER])
    return rows.groupBy(*_STEP_GROUP).agg(expr.alias("val"))


@query("agg_overrides", f"""WITH {FAB_EVENT}, {bindings.cte('fab_rules')}, forced AS (
      SELECT step_desc, concat('FAB_', step_desc, '_', feature_name) AS feature, agg AS rule_agg, 'valid_or_last' AS applied
      FROM fab_rules WHERE feature_name = 'ecuall' AND agg <> 'valid_or_last')
    SELECT feature, rule_agg, applied, count(*) AS n_rows, count(DISTINCT (vehicle, root_lot_id, wafer_id)) AS n_wafers
    FROM event JOIN forced USING (step_desc) GROUP BY ALL""")
def agg_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waferline.sources import rules as rule_tables

    usable, _, overrides = features.fab_rules(rulebook.dicts("fab_rules"), common.REGISTRY)
    step = {r.feature: r.step_desc for r in usable}
    rows = [(step[o["feature"]], o["feature"], o["rule_agg"], o["applied"]) for o in overrides]
    table = rule_tables.table(spark, ["step_desc", "feature", "rule_agg", "applied"], rows)
    hit = common.fab_event(spark, sf_dir).join(table, "step_desc")
    return hit.groupBy("feature", "rule_agg", "applied").agg(
        F.count("*").alias("n_rows"), F.count_distinct(*WAFER).alias("n_wafers")
    )


def _number_query(name: str, kind: str, agg: str) -> None:
    table = FAB_EVENT.split(", event AS")[0] + ", " + (INLINE_EVENT if kind == "INLINE" else VM_EVENT)
    body = number_feature_sql(kind)

    @query(name, f"WITH {table} SELECT vehicle, root_lot_id, wafer_id, feature, round(value_num, 6) AS value_num FROM ({body}) WHERE feature LIKE '%\\_{agg}' ESCAPE '\\'")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = (common.inline_features if kind == "INLINE" else common.vm_features)(spark, sf_dir, [agg])
        return made.withColumn("value_num", F.round("value_num", 6))


for _kind, _agg in (("INLINE", "mean"), ("INLINE", "last"), ("VM", "max"), ("VM", "mean"), ("VM", "min"), ("VM", "first")):
    _number_query(f"{_kind.lower()}_{_agg}", _kind, _agg)


_LAST_PER_STEP = f"""SELECT vehicle, root_lot_id, wafer_id, step_id, step_desc, {last_sql('ppid', 'ppid IS NOT NULL')} AS ppid,
      max(tkout_time) AS t FROM event GROUP BY ALL"""


@query("last_per_step", f"WITH {FAB_EVENT} {_LAST_PER_STEP}")
def last_per_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip.last_per_step(common.fab_event(spark, sf_dir))


_ROUND = "coalesce(value_str, '') AS value_str, round(value_num, 6) AS value_num"
# a text of a number differs between engines, so the checks compare numbers as numbers
_FILLED = """, filled AS (SELECT vehicle, feature FROM long GROUP BY ALL
      HAVING bool_or(trim(coalesce(value_str, '')) <> '' OR value_num IS NOT NULL))"""


@query("feature_long", f"WITH {LONG}{_FILLED} SELECT vehicle, root_lot_id, wafer_id, feature, category, {_ROUND} FROM long JOIN filled USING (vehicle, feature)")
def feature_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = features.with_values(cut_lineage(common.long_features(spark, sf_dir)))  # read twice
    return long.withColumn("value_str", F.coalesce("value_str", F.lit(""))).withColumn("value_num", F.round("value_num", 6))


@query("feature_has_value", f"""WITH {LONG} SELECT vehicle, feature,
      bool_or(trim(coalesce(value_str, '')) <> '' OR value_num IS NOT NULL) AS filled FROM long GROUP BY ALL""")
def feature_has_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = common.long_features(spark, sf_dir)
    return long.groupBy("vehicle", "feature").agg(F.max(features.has_value()).alias("filled"))


@query("feature_catalog", f"""WITH {LONG}, texts AS (SELECT category, feature, vehicle, root_lot_id, wafer_id, coalesce(value_str, printf('%.6f', value_num), '') AS v FROM long)
    SELECT category, feature, count(*) AS n_rows,
      array_to_string(list(v ORDER BY vehicle, root_lot_id, wafer_id)[1:3], ',') AS sample FROM texts GROUP BY ALL""")
def feature_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = cut_lineage(common.long_features(spark, sf_dir))  # read twice
    return features.catalog(long)


@query("feature_coverage", f"""WITH {FAB_EVENT} SELECT vehicle, step_id, count(DISTINCT day) AS days, min(day) AS first_date, max(day) AS last_date
    FROM (SELECT vehicle, step_id, nullif(substr(tkout_time, 1, 10), '') AS day FROM event) GROUP BY ALL""")
def feature_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = common.fab_event(spark, sf_dir)
    event = event.withColumn("day", F.nullif(F.substring("tkout_time", 1, 10), F.lit("")))
    return features.coverage(event, "day", ["vehicle", "step_id"])


_MASK = [("MASK_GATE_PHOTO_reticle", "GATE_PHOTO", "reticleall", "first"),
         ("MASK_WELL_IMPLANT_reticle", "WELL_IMPLANT", "reticleall", "last_valid")]


@query("mask_feature", f"WITH {FAB_EVENT}{SLEUTH} {text_feature_sql(_MASK)}")
def mask_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules, _ = features.mask_rules(rulebook.dicts("mask_rules"), common.REGISTRY)
    return features.text_features(common.fab_event(spark, sf_dir), rules, common.REGISTRY)


_MATRIX_STEPS = ["WELL_IMPLANT", "GATE_STACK", "GATE_ETCH", "SPACER_CVD", "CONTACT_ETCH"]


@query("mask_category", f"""WITH {FAB_EVENT}, {bindings.cte('mask_categories')}, last_reticle AS (
      SELECT vehicle, root_lot_id, wafer_id, step_desc, {last_sql('reticle_id')} AS reticle_id FROM event
      WHERE trim(coalesce(reticle_id, '')) <> '' AND step_desc IN ({', '.join(f"'{s}'" for s in _MATRIX_STEPS)}) GROUP BY ALL)
    SELECT vehicle, root_lot_id, wafer_id, concat('MASK_', step_desc) AS feature, category
    FROM last_reticle JOIN mask_categories USING (reticle_id)""")
def mask_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = common.fab_event(spark, sf_dir)
    return history.mask_category(event, _MATRIX_STEPS, bindings.rules(spark, "mask_categories"))


_USABLE = """event WHERE step_desc = 'GATE_STACK' OR coalesce(NOT regexp_matches(ppid, '^skip'), false)"""
_MATRIX = f"""matrix_long AS (SELECT vehicle, root_lot_id, wafer_id, step_desc, {last_sql('ppid')} AS ppid FROM {_USABLE} GROUP BY ALL),
    matrix AS (SELECT vehicle, root_lot_id, wafer_id,
      {', '.join(f"max(ppid) FILTER (WHERE step_desc = '{s}') AS {s}_PPID" for s in _MATRIX_STEPS)} FROM matrix_long GROUP BY ALL)"""


def recipe_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.usable_recipes(common.fab_event(spark, sf_dir), ["GATE_STACK"], "^skip")
    return history.wafer_matrix(rows, "ppid", _MATRIX_STEPS, "_PPID")


@query("wafer_matrix", f"WITH {FAB_EVENT}, {_MATRIX} SELECT * FROM matrix")
def wafer_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipe_matrix(spark, sf_dir)


@query("unpivot_matrix", f"""WITH {FAB_EVENT}, {_MATRIX} {' UNION ALL '.join(
    f"SELECT vehicle, root_lot_id, wafer_id, '{s}_PPID' AS step, {s}_PPID AS ppid FROM matrix" for s in _MATRIX_STEPS)}""")
def unpivot_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.unpivot(recipe_matrix(spark, sf_dir), [f"{s}_PPID" for s in _MATRIX_STEPS], "ppid")


@query("qtime", f"""WITH {FAB_EVENT}, timed AS (
      SELECT e.vehicle, e.root_lot_id, e.wafer_id, e.step_desc, e.ppid, e.arrival, o.o_orderdate,
        CASE WHEN e.tkout_time = '' THEN NULL ELSE substr(e.arrival, 25) END AS shipped
      FROM event e JOIN orders o ON o.o_orderkey = cast(substr(e.arrival, 1, 12) AS bigint))
    SELECT vehicle, root_lot_id, wafer_id, concat('FAB_', step_desc, '_QTIME') AS feature,
      abs(date_diff('second', last(o_orderdate ORDER BY shipped, arrival), cast(last(shipped ORDER BY shipped, arrival) AS timestamp))) AS qtime
    FROM timed WHERE shipped IS NOT NULL AND NOT coalesce(step_desc = 'GATE_ETCH' AND ppid = 'PP_A0', false) GROUP BY vehicle, root_lot_id, wafer_id, step_desc""")
def qtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = common.fab_event(spark, sf_dir).withColumn("o_orderkey", F.substring("arrival", 1, 12).cast("bigint"))
    orders = bindings.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shipped = F.when(F.col("tkout_time") == "", None).otherwise(F.substring("arrival", 25, 10))
    rows = event.withColumn("shipped", shipped).join(orders, "o_orderkey")
    rows = rows.withColumn("shipped_at", F.col("shipped").cast("timestamp"))
    return history.queue_time(rows, "shipped_at", "o_orderdate", ["shipped", "arrival"], "GATE_ETCH", "PP_A0")


@query("vm_item_last", f"""WITH {bindings.cte('item_raw', 'item_rules')}, latest AS (
      SELECT vehicle, root_lot_id, wafer_id, step_desc, item_id, try_cast(last(fab_value ORDER BY time) AS double) AS value
      FROM item_raw JOIN item_rules USING (step_desc, item_id) WHERE subitem_id = 'VALUE' GROUP BY ALL)
    SELECT vehicle, root_lot_id, wafer_id, concat('VM_', step_desc, '_', item_id) AS feature, value FROM latest WHERE value <> 0""")
def vm_item_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "item_raw")
    return history.item_last(raw, bindings.rules(spark, "item_rules"), "VALUE", "VM", ["time"])


_DEVIATIONS = 5


@query("mad_outliers", f"""WITH centred AS (SELECT event_id, event_type, value, median(value) OVER (PARTITION BY event_type) AS centre FROM events),
    spread AS (SELECT *, median(abs(value - centre)) OVER (PARTITION BY event_type) AS mad FROM centred)
    SELECT event_id, event_type, CASE WHEN mad >= 1e-9 AND abs(value - centre) > {_DEVIATIONS} * mad THEN NULL ELSE value END AS value FROM spread""")
def mad_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_table = bindings.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    out = history.null_outliers(events_table, ["event_type"], "value", _DEVIATIONS)
    return out.select("event_id", "event_type", "value")
