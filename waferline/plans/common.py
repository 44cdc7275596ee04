"""Events and other inputs that several registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.functions.registry import Registry
from waferline.operators import event as events
from waferline.operators import features
from waferline.plans import bindings, rulebook
from waferline.session import cut_lineage
from waferline.sources import rules as rule_tables
from waferline.sources.schema import FAB, INLINE, VM

REGISTRY = Registry()
STEP_KEYS = ["vehicle", "step_id"]
# the event columns that a value rule, an order or a knob map can ask for
FEATURE_COLUMNS = [
    "vehicle", "root_lot_id", "wafer_id", "step_id", "step_desc", "tkout_time", "arrival", "part_id", "ppid",
    "reticle_id", "eqp_id", "chamber_id", "unit_id", "sleuth_order",
]


def step_map(spark: SparkSession) -> DataFrame:
    numbered = bindings.rules(spark, "step_map").withColumn("pos", F.monotonically_increasing_id())
    return rule_tables.unique_steps(numbered, STEP_KEYS)


def fab_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    extra = ["vehicle", "split", "arrival", "area"]
    return events.build(raw, FAB, rulebook.LOT_PREFIX, step_map(spark), STEP_KEYS, extra)


def inline_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw")
    items = bindings.rules(spark, "inline_rules")
    return events.build(raw, INLINE, rulebook.LOT_PREFIX, items, [], ["vehicle", "split"])


def vm_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "vm_raw")
    return events.build(raw, VM, rulebook.LOT_PREFIX, step_map(spark), STEP_KEYS, ["vehicle"])


def long_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long feature table of all five families, from an event table written once."""
    from waferline.operators import knob

    event = cut_lineage(fab_event(spark, sf_dir).select(*FEATURE_COLUMNS), plain=["arrival"])
    fab, _, _ = features.fab_rules(rulebook.dicts("fab_rules"), REGISTRY)
    mask, _ = features.mask_rules(rulebook.dicts("mask_rules"), REGISTRY)
    text = features.text_features(event, fab + mask, REGISTRY)
    category = F.when(F.col("feature").startswith("MASK_"), "MASK").otherwise("FAB")
    long = features.as_long(text, "FAB").withColumn("category", category)
    looked_up = knob.lookup(event, knob.map_from_rules(bindings.rules(spark, "knob_rules"), step_map(spark)))
    aggs, _ = knob.aggregates_used(rulebook.dicts("knob_rules"), REGISTRY)
    long = long.unionByName(features.as_long(knob.features(looked_up, REGISTRY, aggs), "KNOB"))
    long = long.unionByName(features.as_long(inline_features(spark, sf_dir), "INLINE"))
    return long.unionByName(features.as_long(vm_features(spark, sf_dir), "VM"))


def inline_features(spark: SparkSession, sf_dir: str, aggs: list[str] | None = None) -> DataFrame:
    rules, _ = features.number_rules(rulebook.dicts("inline_rules"), "INLINE", REGISTRY)
    rules = [r for r in rules if aggs is None or r.agg in aggs]
    return features.number_features(inline_event(spark, sf_dir), rules, "item_id", "value", ["time"], REGISTRY)


def vm_features(spark: SparkSession, sf_dir: str, aggs: list[str] | None = None) -> DataFrame:
    rules, _ = features.number_rules(rulebook.dicts("vm_rules"), "VM", REGISTRY)
    rules = [r for r in rules if aggs is None or r.agg in aggs]
    return features.number_features(vm_event(spark, sf_dir), rules, "sensor_id", "residual", ["time"], REGISTRY)


# ── the same inputs for the SQL checks ──

FAB_EVENT = bindings.cte("fab_raw", "step_map") + """, event AS (
    SELECT r.* REPLACE (s.step_desc AS step_desc) FROM fab_raw r
    JOIN step_map s ON r.vehicle = s.vehicle AND trim(r.step_id) = s.step_id WHERE starts_with(r.root_lot_id, 'R'))"""

INLINE_EVENT = bindings.cte("inline_raw", "inline_rules") + """, inline_event AS (
    SELECT * FROM inline_raw WHERE starts_with(root_lot_id, 'R') AND item_id IN (SELECT item_id FROM inline_rules))"""

VM_EVENT = bindings.cte("vm_raw", "vm_rules") + """, vm_event AS (
    SELECT r.* FROM vm_raw r JOIN step_map s ON r.vehicle = s.vehicle AND r.step_id = s.step_id
    WHERE starts_with(r.root_lot_id, 'R'))"""

# value rules in SQL
_C = "nullif(trim({}), '')"
VALUE_SQL = {
    "eqpall": "concat_ws('|', {t}, concat_ws('_', {e}, {c}, {u}))".format(
        t=_C.format("tkout_time"), e=_C.format("eqp_id"), c=_C.format("chamber_id"), u=_C.format("unit_id")
    ),
    "ecuall": "concat_ws('_', nullif({e}, '-'), nullif({c}, '-'), nullif({u}, '-'))".format(
        e=_C.format("eqp_id"), c=_C.format("chamber_id"), u=_C.format("unit_id")
    ),
    "reticleall": "concat_ws('|', substr({p}, 1, 10), {r})".format(p=_C.format("part_id"), r=_C.format("reticle_id")),
    "tkout_status": "CASE WHEN tkout_time IS NOT NULL THEN 'PASSED' ELSE 'NOT_PASSED' END",
    "part_id": "substr(part_id, 1, 10)",
}
SORT = "ORDER BY tkout_time NULLS FIRST, arrival"

# the rank of a wafer among its lot's wafers at a step
SLEUTH = """, sleuth AS (SELECT *, coalesce(nullif(nullif(trim(sleuth_order), ''), '-'),
    cast(dense_rank() OVER (PARTITION BY vehicle, step_id, root_lot_id
      ORDER BY coalesce(lpad(cast(try_cast(trim(wafer_id) AS bigint) AS varchar), 9, '0'), wafer_id) NULLS FIRST) AS varchar)) AS seq FROM event)"""


def last_sql(val: str, test: str = "") -> str:
    return f"last({val} {SORT}){f' FILTER (WHERE {test})' if test else ''}"


def first_sql(val: str, test: str = "") -> str:
    return f"first({val} {SORT}){f' FILTER (WHERE {test})' if test else ''}"


def agg_sql(agg: str, val: str) -> str:
    """One text aggregate in SQL."""
    upper = f"upper(trim({val}))"
    text = f"nullif(trim({val}), '')"
    return {
        "first": first_sql(val),
        "last": last_sql(val),
        "concat": f"coalesce(string_agg(trim({val}), '_' {SORT}), '')",
        "agg": f"coalesce(string_agg(DISTINCT {val}, '_' ORDER BY {val}), '')",
        "last_valid": last_sql(upper, f"{upper} IS NOT NULL AND {upper} NOT IN ('', '-') AND {upper} NOT LIKE '%SKIP%'"),
        "valid_eqp": first_sql(f"trim({val})", f"regexp_matches(trim({val}), '_[A-Za-z0-9]*[0-9]')"),
        "valid_or_last": f"""coalesce({last_sql(text, f"regexp_matches({text}, '_[^_]*[0-9][^_]*$')")}, {last_sql(text, f"{text} IS NOT NULL")})""",
    }[agg]


# the knob map of the rule form, and the event rows it looks up
KNOB_MAP = bindings.cte("knob_rules") + """, knob_single AS (
    SELECT *, count(*) OVER (PARTITION BY feature_name, rule_order) AS block_rows FROM knob_rules),
  knob_eq AS (
    SELECT *, coalesce(try_cast(nullif(regexp_extract(rule_order, '(\\d+)', 1), '') AS bigint), 1000000) AS rule_num FROM knob_single
    WHERE block_rows = 1 AND upper(trim(coalesce("use", ''))) IN ('', 'Y', '1', 'TRUE') AND trim(coalesce(operator, '')) = 'eq'
      AND upper(trim(coalesce(rule_order, ''))) <> 'RO' AND trim(coalesce(value, '')) <> '' AND trim(coalesce(category, '')) <> ''),
  knob_map AS (
    SELECT s.vehicle, s.step_id, s.step_desc, k.value AS ppid, k.category AS knob, k.agg, k.rule_num, k.pos
    FROM (SELECT DISTINCT vehicle, step_id, step_desc FROM step_map) s JOIN knob_eq k ON s.step_desc = trim(k.function_step)
    QUALIFY row_number() OVER (PARTITION BY s.vehicle, s.step_id, k.value ORDER BY k.rule_num, k.pos) = 1)"""

KNOB_LOOKUP = KNOB_MAP + """, knob_steps AS (
    SELECT vehicle, step_id, first(step_desc ORDER BY rule_num, pos) AS knob_desc,
      coalesce(first(trim(agg) ORDER BY rule_num, pos) FILTER (WHERE trim(coalesce(agg, '')) <> ''), 'last') AS agg,
      min(rule_num * 1000 + pos) AS map_order FROM knob_map GROUP BY ALL),
  looked_up AS (
    SELECT e.*, s.knob_desc, s.agg, s.map_order, m.knob FROM event e JOIN knob_steps s USING (vehicle, step_id)
    LEFT JOIN knob_map m ON e.vehicle = m.vehicle AND e.step_id = m.step_id AND e.ppid = m.ppid)"""

KNOB_FEATURE = KNOB_LOOKUP + f""", present AS (SELECT DISTINCT vehicle, knob_desc, step_id, map_order FROM looked_up),
  winner AS (SELECT vehicle, knob_desc, arg_max(step_id, (map_order, step_id)) AS step_id FROM present GROUP BY ALL),
  knob_feature AS (
    SELECT vehicle, root_lot_id, wafer_id, concat('KNOB_', knob_desc, '_ppid') AS feature,
      CASE agg WHEN 'last' THEN {last_sql("coalesce(knob, ppid)")} WHEN 'concat' THEN {agg_sql("concat", "coalesce(knob, ppid)")}
        WHEN 'agg' THEN {agg_sql("agg", "coalesce(knob, ppid)")} ELSE {agg_sql("last_valid", "coalesce(knob, ppid)")} END AS value_str
    FROM looked_up JOIN winner USING (vehicle, knob_desc, step_id) GROUP BY vehicle, root_lot_id, wafer_id, knob_desc, agg)"""


def text_feature_sql(rules: list[tuple[str, str, str, str]], source: str = "sleuth") -> str:
    """(feature, step, value, agg) rules as a union, one select per rule."""
    parts = []
    for feature, step, value, agg in rules:
        val = {"sleuth_order": "seq"}.get(value) or VALUE_SQL.get(value, value)
        keep = " HAVING value_str IS NOT NULL" if agg == "valid_eqp" else ""
        parts.append(
            f"SELECT vehicle, root_lot_id, wafer_id, '{feature}' AS feature, {agg_sql(agg, val)} AS value_str "
            f"FROM {source} WHERE step_desc = '{step}' GROUP BY vehicle, root_lot_id, wafer_id{keep}"
        )
    return " UNION ALL ".join(parts)


def number_feature_sql(kind: str) -> str:
    table, item, value = (
        ("inline_event", "item_id", "value") if kind == "INLINE" else ("vm_event", "sensor_id", "residual")
    )
    middle = "" if kind == "INLINE" else "residual_"
    parts = []
    for r in rulebook.dicts(f"{kind.lower()}_rules"):
        agg = {
            "mean": f"avg({value})", "max": f"max({value})", "min": f"min({value})",
            "last": f"last({value} ORDER BY time)", "first": f"first({value} ORDER BY time)",
        }[r["agg"]]
        parts.append(
            f"SELECT vehicle, root_lot_id, wafer_id, '{kind}_{r[item]}_{middle}{r['agg']}' AS feature, {agg} AS value_num "
            f"FROM {table} WHERE {item} = '{r[item]}' GROUP BY vehicle, root_lot_id, wafer_id"
        )
    return " UNION ALL ".join(parts)


def _text_rules() -> list[tuple[str, str, str, str]]:
    fab, _, _ = features.fab_rules(rulebook.dicts("fab_rules"), REGISTRY)
    mask, _ = features.mask_rules(rulebook.dicts("mask_rules"), REGISTRY)
    return [(r.feature, r.step_desc, r.value, r.agg) for r in fab + mask]


LONG = (
    FAB_EVENT + SLEUTH + ", " + KNOB_FEATURE + ", " + INLINE_EVENT + ", " + VM_EVENT
    + f""", long AS (
    SELECT vehicle, root_lot_id, wafer_id, feature, split_part(feature, '_', 1) AS category, value_str, cast(NULL AS double) AS value_num FROM ({text_feature_sql(_text_rules())})
    UNION ALL SELECT vehicle, root_lot_id, wafer_id, feature, 'KNOB', value_str, NULL FROM knob_feature
    UNION ALL SELECT vehicle, root_lot_id, wafer_id, feature, 'INLINE', NULL, value_num FROM ({number_feature_sql("INLINE")})
    UNION ALL SELECT vehicle, root_lot_id, wafer_id, feature, 'VM', NULL, value_num FROM ({number_feature_sql("VM")}))"""
)
