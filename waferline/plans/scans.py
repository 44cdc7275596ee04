"""Queries that look for unmapped steps and recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.operators import alerts, knob, scan
from waferline.plans import bindings, common
from waferline.plans.common import KNOB_MAP
from waferline.plans.registry import query
from waferline.session import cut_lineage

_RAW = "WITH " + bindings.cte("fab_raw", "step_map")
_NEW = "(vehicle, step_id) NOT IN (SELECT (vehicle, step_id) FROM step_map)"
_COMBO = ["vehicle", "step_id", "step_desc", "eqp_id", "eqp_model"]
_COMBOS = f"""combos AS (SELECT {', '.join(_COMBO)}, count(*) AS n_rows, count(DISTINCT root_lot_id) AS n_lots FROM fab_raw WHERE {_NEW} GROUP BY ALL)"""
_EQP, _MODEL = ["AUX", "EQP_0[12]"], ["MEA-*", "GEN-?"]
_REASON = """CASE WHEN eqp_id = 'AUX' THEN 'eqp_id ~ ''AUX''' WHEN regexp_matches(eqp_id, '^EQP_0[12]$') THEN 'eqp_id ~ ''EQP_0[12]'''
      WHEN eqp_model LIKE 'MEA-%' THEN 'eqp_model ~ ''MEA-*''' WHEN regexp_matches(eqp_model, '^GEN-.$') THEN 'eqp_model ~ ''GEN-?''' END"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.bound(spark, sf_dir, "fab_raw")


def combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.unmatched(raw(spark, sf_dir), bindings.rules(spark, "step_map"), _COMBO)


@query("unmatched_steps", f"{_RAW}, {_COMBOS} SELECT * FROM combos WHERE ({_REASON}) IS NULL")
def unmatched_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combos(spark, sf_dir).where(scan.exclusion_reason(_EQP, _MODEL).isNull())


@query("unmatched_excluded", f"{_RAW}, {_COMBOS} SELECT *, {_REASON} AS excluded_by FROM combos WHERE ({_REASON}) IS NOT NULL")
def unmatched_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = combos(spark, sf_dir).withColumn("excluded_by", scan.exclusion_reason(_EQP, _MODEL))
    return marked.where(F.col("excluded_by").isNotNull())


_MAIN = "coalesce(step_desc NOT LIKE 'MEASURE%', true) AND coalesce(eqp_model NOT LIKE 'MEA-%', true)"


@query("main_step_filter", f"{_RAW} SELECT arrival, wafer_id, step_id, step_desc, eqp_model FROM fab_raw WHERE {_MAIN}")
def main_step_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir).select("arrival", "wafer_id", "step_id", "step_desc", "eqp_model")
    return scan.main_steps_only(rows, ["MEASURE*"], ["MEA-*"])


_HINT = scan.hint_settings({"days": "200", "neighbors": None, "value_limit": 4, "example_limit": 5})
_DAYS = f"""dated AS (SELECT *, substr(tkout_time, 1, 10) AS day FROM fab_raw),
    days AS (SELECT DISTINCT day FROM dated WHERE coalesce(day, '') <> '' ORDER BY day DESC LIMIT {{days}})"""


def recent(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    dated = raw(spark, sf_dir).withColumn("day", F.substring("tkout_time", 1, 10))
    return dated.join(scan.recent_dates(dated, "day", days), "day", "left_semi")


@query("recent_n_dates", f"{_RAW}, {_DAYS.format(days=_HINT['days'])} SELECT arrival, wafer_id, day FROM dated WHERE day IN (SELECT day FROM days)")
def recent_n_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent(spark, sf_dir, _HINT["days"]).select("arrival", "wafer_id", "day")


_STATS = "stats AS (SELECT vehicle, step_id, count(*) AS n_rows, count(DISTINCT root_lot_id) AS n_lots FROM fab_raw GROUP BY ALL)"


@query("step_neighbors", f"""{_RAW}, {_STATS}, numbered AS (
      SELECT *, regexp_extract(step_id, '^(.*?)(\\d+)$', 1) AS prefix, try_cast(nullif(regexp_extract(step_id, '^(.*?)(\\d+)$', 2), '') AS bigint) AS number,
        length(regexp_extract(step_id, '^(.*?)(\\d+)$', 2)) AS width FROM stats),
    pairs AS (SELECT n.vehicle, n.step_id, k.step_id AS neighbor, s.step_desc, k.n_rows AS neighbor_rows, k.n_lots AS neighbor_lots,
        CASE WHEN k.number < n.number THEN 'prev' ELSE 'next' END AS direction, abs(k.number - n.number) AS gap
      FROM numbered n JOIN numbered k ON n.vehicle = k.vehicle AND n.prefix = k.prefix AND n.width = k.width AND n.number <> k.number
      JOIN step_map s ON s.vehicle = k.vehicle AND s.step_id = k.step_id
      WHERE (n.vehicle, n.step_id) NOT IN (SELECT (vehicle, step_id) FROM step_map) AND n.number IS NOT NULL)
    SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY vehicle, step_id, direction ORDER BY gap) <= {_HINT['neighbors']}""")
def step_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row per step, used for the new and for the known steps: count the rows once
    stats = cut_lineage(scan.step_stats(raw(spark, sf_dir), ["vehicle", "step_id"]))
    return scan.neighbors(stats, bindings.rules(spark, "step_map"), _HINT["neighbors"])


_COLUMNS = ["ppid", "eqp_id", "eqp_model", "area"]


@query("step_values", f"""{_RAW}, {_DAYS.format(days=_HINT['days'])}, long AS ({' UNION ALL '.join(
    f"SELECT vehicle, step_id, '{c}' AS \"column\", {c} AS value, tkout_time, arrival FROM dated WHERE day IN (SELECT day FROM days)" for c in _COLUMNS)}),
    firsts AS (SELECT vehicle, step_id, "column", value, min((tkout_time, arrival)) AS seen FROM long WHERE value IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY vehicle, step_id, "column" ORDER BY seen) AS rank FROM firsts)
    SELECT vehicle, step_id, "column", value, rank FROM ranked WHERE rank <= {_HINT['value_limit']} AND value <> ''""")
def step_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent(spark, sf_dir, _HINT["days"])
    return scan.step_values(rows, ["vehicle", "step_id"], _COLUMNS, ["tkout_time", "arrival"], _HINT["value_limit"])


_VALUE_LISTS = f"""picked AS (SELECT vehicle, step_id, "column", string_agg(value, ',' ORDER BY rank) AS vals FROM (
      SELECT *, row_number() OVER (PARTITION BY vehicle, step_id, "column" ORDER BY seen) AS rank FROM firsts) WHERE rank <= {_HINT['value_limit']} AND value <> '' GROUP BY ALL),
    seen_stats AS (SELECT vehicle, step_id, count(*) AS n_rows, count(DISTINCT root_lot_id) AS n_lots FROM dated WHERE day IN (SELECT day FROM days) GROUP BY ALL),
    wanted AS (SELECT DISTINCT vehicle, step_id FROM fab_raw WHERE {_NEW}),
    all_steps AS (SELECT * FROM seen_stats UNION ALL SELECT vehicle, step_id, 0, 0 FROM wanted WHERE (vehicle, step_id) NOT IN (SELECT (vehicle, step_id) FROM seen_stats)),
    parsed AS (SELECT *, regexp_extract(step_id, '^(.*?)(\\d+)$', 1) AS prefix, try_cast(nullif(regexp_extract(step_id, '^(.*?)(\\d+)$', 2), '') AS bigint) AS number,
      length(regexp_extract(step_id, '^(.*?)(\\d+)$', 2)) AS width FROM all_steps),
    close AS (SELECT n.vehicle, n.step_id, k.step_id AS neighbor, s.step_desc, k.n_rows AS neighbor_rows, k.n_lots AS neighbor_lots,
        CASE WHEN k.number < n.number THEN 'prev' ELSE 'next' END AS direction, abs(k.number - n.number) AS gap
      FROM parsed n JOIN parsed k ON n.vehicle = k.vehicle AND n.prefix = k.prefix AND n.width = k.width AND n.number <> k.number
      JOIN step_map s ON s.vehicle = k.vehicle AND s.step_id = k.step_id
      WHERE (n.vehicle, n.step_id) IN (SELECT (vehicle, step_id) FROM wanted) AND n.number IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY n.vehicle, n.step_id, k.number < n.number ORDER BY abs(k.number - n.number)) <= {_HINT['neighbors']})"""


@query("step_hints", f"""{_RAW}, {_DAYS.format(days=_HINT['days'])}, long AS ({' UNION ALL '.join(
    f"SELECT vehicle, step_id, '{c}' AS \"column\", {c} AS value, tkout_time, arrival FROM dated WHERE day IN (SELECT day FROM days)" for c in _COLUMNS)}),
    firsts AS (SELECT vehicle, step_id, "column", value, min((tkout_time, arrival)) AS seen FROM long WHERE value IS NOT NULL GROUP BY ALL), {_VALUE_LISTS}
    SELECT a.vehicle, a.step_id, a.n_rows, a.n_lots, c.neighbor, c.step_desc, c.direction, c.gap, c.neighbor_rows, c.neighbor_lots, v.col AS "column",
      own.vals AS own_values, other.vals AS neighbor_values
    FROM (SELECT * FROM all_steps WHERE (vehicle, step_id) IN (SELECT (vehicle, step_id) FROM wanted)) a CROSS JOIN (VALUES {', '.join(f"('{c}')" for c in _COLUMNS)}) AS v(col)
    LEFT JOIN close c ON a.vehicle = c.vehicle AND a.step_id = c.step_id
    LEFT JOIN picked own ON own.vehicle = a.vehicle AND own.step_id = a.step_id AND own."column" = v.col
    LEFT JOIN picked other ON other.vehicle = a.vehicle AND other.step_id = c.neighbor AND other."column" = v.col""")
def step_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hints as one row per unmapped step, neighbour and column, values as text."""
    steps = bindings.rules(spark, "step_map")
    wanted = raw(spark, sf_dir).join(steps, ["vehicle", "step_id"], "left_anti").select("vehicle", "step_id").distinct()
    rows = recent(spark, sf_dir, _HINT["days"])
    found = scan.hints(rows, wanted, steps, _COLUMNS, ["tkout_time", "arrival"], _HINT)
    found = found.withColumn("neighbor", F.explode_outer("neighbors")).withColumn("column", F.explode(F.array(*[F.lit(c) for c in _COLUMNS])))
    def text(lists: str):
        return F.array_join(F.try_element_at(F.col(lists), F.col("column")), ",")
    return found.select(
        "vehicle", "step_id", "n_rows", "n_lots", F.col("neighbor.step_id").alias("neighbor"), "neighbor.step_desc", "neighbor.direction", "neighbor.gap",
        F.col("neighbor.n_rows").alias("neighbor_rows"), F.col("neighbor.n_lots").alias("neighbor_lots"), "column",
        text("values").alias("own_values"), text("neighbor.values").alias("neighbor_values"),
    )


@query("step_examples", f"""{_RAW}, pairs AS (
      SELECT vehicle, step_id, root_lot_id, wafer_id, min(arrival) AS seen FROM fab_raw WHERE {_NEW} GROUP BY vehicle, step_id, root_lot_id, wafer_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY vehicle, step_id, root_lot_id ORDER BY seen) > 1 AS later FROM pairs)
    SELECT vehicle, step_id, root_lot_id, wafer_id, row_number() OVER (PARTITION BY vehicle, step_id ORDER BY later, seen) AS rank FROM ranked
    QUALIFY rank <= {_HINT['example_limit']}""")
def step_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = bindings.rules(spark, "step_map").select("vehicle", "step_id").distinct()
    rows = raw(spark, sf_dir).join(mapped, ["vehicle", "step_id"], "left_anti")
    return scan.step_examples(rows, ["vehicle", "step_id"], ["arrival"], _HINT["example_limit"])


_HITS = "array_to_string(list(DISTINCT pair ORDER BY pair)[1:10], ',') AS hits"
_DATA = f"""data AS (SELECT *, concat(root_lot_id, ':', wafer_id) AS pair FROM fab_raw
      WHERE {_MAIN} AND eqp_id IN ('EQP_00', 'EQP_01', 'EQP_02', 'EQP_03', 'AUX'))"""
_MISSING = f"missing AS (SELECT vehicle, step_id, count(DISTINCT root_lot_id) AS n_lots, {_HITS} FROM data WHERE {_NEW} GROUP BY ALL)"


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = ["EQP_00", "EQP_01", "EQP_02", "EQP_03", "AUX"]
    data = scan.equipment_only(raw(spark, sf_dir), "eqp_id", tools)
    return scan.main_steps_only(data, ["MEASURE*"], ["MEA-*"])


@query("missing_steps", f"{_RAW}, {_DATA}, {_MISSING} SELECT * FROM missing")
def missing_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.missing_steps(scanned(spark, sf_dir), bindings.rules(spark, "step_map"), ["vehicle", "step_id"], 10)


_UNMATCHED = f"""existing AS (SELECT vehicle, step_id, string_agg(DISTINCT ppid, ',' ORDER BY ppid) AS existing FROM knob_map GROUP BY ALL),
    unknown AS (SELECT d.vehicle, d.step_id, d.ppid, {_HITS}, e.existing FROM data d JOIN existing e USING (vehicle, step_id)
      WHERE d.ppid IS NOT NULL AND (d.vehicle, d.step_id, d.ppid) NOT IN (SELECT (vehicle, step_id, ppid) FROM knob_map) GROUP BY d.vehicle, d.step_id, d.ppid, e.existing)"""


def unknown_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = knob.map_from_rules(bindings.rules(spark, "knob_rules"), common.step_map(spark))
    return scan.unmatched_recipes(scanned(spark, sf_dir), known, 10)


@query("unmatched_ppids", f"{_RAW}, {KNOB_MAP}, {_DATA}, {_UNMATCHED} SELECT * FROM unknown")
def unmatched_ppids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_recipes(spark, sf_dir)


@query("scan_ignored", f"""{_RAW}, {KNOB_MAP}, {_DATA}, {_MISSING}, {_UNMATCHED}
    SELECT 'step' AS kind, vehicle, step_id, '' AS ppid, hits FROM missing WHERE step_id <> 'AX550000'
    UNION ALL SELECT 'ppid', vehicle, step_id, ppid, hits FROM unknown WHERE concat(step_id, ':', ppid) <> 'CC902000:PP_R0'""")
def scan_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ignored = bindings.rules(spark, "ignored")
    steps = scan.without_ignored(missing_steps(spark, sf_dir), ignored, "step")
    recipes = scan.without_ignored(unknown_recipes(spark, sf_dir), ignored, "ppid")
    steps = steps.select(F.lit("step").alias("kind"), "vehicle", "step_id", F.lit("").alias("ppid"), "hits")
    return steps.unionByName(recipes.select(F.lit("ppid").alias("kind"), "vehicle", "step_id", "ppid", "hits"))


def _distinct_text(column: str) -> str:
    return f"coalesce(string_agg(DISTINCT {column}, ', ' ORDER BY {column}) FILTER (WHERE trim(coalesce({column}, '')) <> ''), '') AS {column}"


@query("alert_rollup", f"""{_RAW}, {_COMBOS} SELECT vehicle, step_id, cast(sum(n_rows) AS bigint) AS n_rows, max(n_lots) AS n_lots,
      {_distinct_text('eqp_id')}, {_distinct_text('eqp_model')} FROM combos GROUP BY vehicle, step_id""")
def alert_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.roll_up(combos(spark, sf_dir), ["vehicle", "step_id"])




@query("scan_summary", f"""{_RAW}, {KNOB_MAP}, {_DATA}, {_MISSING}, {_UNMATCHED}
    SELECT vehicle, count(*) AS total_rows, (SELECT count(*) FROM step_map s WHERE s.vehicle = d.vehicle) AS matching_steps,
      (SELECT count(DISTINCT step_id) FROM knob_map k WHERE k.vehicle = d.vehicle) AS knob_steps,
      (SELECT count(*) FROM missing m WHERE m.vehicle = d.vehicle) AS missing_count,
      (SELECT count(*) FROM unknown u WHERE u.vehicle = d.vehicle) AS unmatched_count FROM data d GROUP BY vehicle""")
def scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = knob.map_from_rules(bindings.rules(spark, "knob_rules"), common.step_map(spark))
    return scan.summary(
        scanned(spark, sf_dir), missing_steps(spark, sf_dir), unknown_recipes(spark, sf_dir),
        bindings.rules(spark, "step_map"), known,
    )
