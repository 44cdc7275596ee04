"""Queries over value rules, text cleaning and conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.functions import text
from waferline.functions.conditions import check_filter, condition
from waferline.operators.features import add_wafer_rank
from waferline.plans import bindings, common
from waferline.plans.common import FAB_EVENT, SLEUTH, VALUE_SQL
from waferline.plans.registry import query
from waferline.sources import adhoc

FAB_RAW = "WITH " + bindings.cte("fab_raw")


def _value_query(rule: str) -> None:
    @query(f"val_{rule}", f"{FAB_RAW} SELECT arrival, wafer_id, step_id, {VALUE_SQL[rule]} AS val FROM fab_raw")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = bindings.bound(spark, sf_dir, "fab_raw")
        return raw.select("arrival", "wafer_id", "step_id", common.REGISTRY.value(rule).alias("val"))


for _rule in ("eqpall", "ecuall", "reticleall", "tkout_status"):
    _value_query(_rule)


@query("valid_tool_filter", f"""{FAB_RAW} SELECT arrival, wafer_id, {VALUE_SQL['ecuall']} AS tool FROM fab_raw
    WHERE regexp_matches({VALUE_SQL['ecuall']}, '_[^_]*[0-9][^_]*$')""")
def valid_tool_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    rows = raw.select("arrival", "wafer_id", common.REGISTRY.value("ecuall").alias("tool"))
    return rows.where(F.col("tool").rlike(text.VALID_TOOL))


@query("step_id_parse", f"""{FAB_RAW} SELECT step_id, count(*) AS n,
      CASE WHEN regexp_matches(step_id, '\\d$') THEN regexp_extract(trim(step_id), '^(.*?)(\\d+)$', 1) END AS prefix,
      try_cast(nullif(regexp_extract(trim(step_id), '^(.*?)(\\d+)$', 2), '') AS bigint) AS number,
      length(nullif(regexp_extract(trim(step_id), '^(.*?)(\\d+)$', 2), '')) AS width
    FROM fab_raw GROUP BY step_id""")
def step_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    return raw.groupBy("step_id").agg(F.count("*").alias("n")).select(
        "step_id", "n", text.step_prefix("step_id").alias("prefix"),
        text.step_number("step_id").alias("number"), text.step_width("step_id").alias("width"),
    )


_CONDITIONS = [
    ("eq", "PP_A0"), ("neq", "PP_A0"), ("contains", "^PP_[AR]"), ("in", "PP_A0|PP_N1|-"),
    ("not_in", "PP_A0|PP_N1"), ("_null", ""), ("not_null", ""), ("odd", "x"),
]


@query("cond_ops", f"""{FAB_RAW} SELECT arrival, wafer_id, coalesce(ppid = 'PP_A0', false) AS c_eq,
      coalesce(ppid <> 'PP_A0', false) AS c_neq, coalesce(regexp_matches(ppid, '^PP_[AR]'), false) AS c_contains,
      coalesce(ppid IN ('PP_A0', 'PP_N1', '-'), false) AS c_in, coalesce(ppid NOT IN ('PP_A0', 'PP_N1'), false) AS c_not_in,
      ppid IS NULL AS c__null, ppid IS NOT NULL AS c_not_null, true AS c_odd FROM fab_raw""")
def cond_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    tests = [condition(op, value, "ppid").alias(f"c_{op}") for op, value in _CONDITIONS]
    return raw.select("arrival", "wafer_id", *tests)


_CHECKS = ["eq pp_a0", "not null", "null", "startswith pp_n", "contains kip", "odd", ""]


@query("check_filters", f"""{FAB_RAW} SELECT step_id, count(*) FILTER (WHERE upper(trim(ppid)) = 'PP_A0') AS n0,
      count(*) FILTER (WHERE trim(coalesce(ppid, '')) <> '') AS n1, count(*) FILTER (WHERE trim(coalesce(ppid, '')) = '') AS n2,
      count(*) FILTER (WHERE upper(trim(ppid)) LIKE 'PP\\_N%' ESCAPE '\\') AS n3,
      count(*) FILTER (WHERE upper(ppid) LIKE '%KIP%') AS n4, count(*) AS n5, count(*) AS n6 FROM fab_raw GROUP BY step_id""")
def check_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    counts = [F.sum(check_filter("ppid", c).cast("int")).cast("bigint").alias(f"n{i}") for i, c in enumerate(_CHECKS)]
    return raw.groupBy("step_id").agg(*counts)


@query("wafer_normalize", f"""WITH {bindings.cte('inline_raw')} SELECT wafer_id,
      try_cast(nullif(regexp_replace(trim(wafer_id), '\\D', '', 'g'), '') AS bigint) AS wafer, count(*) AS n
    FROM (SELECT CASE WHEN item_id = 'error' THEN ' bad ' ELSE wafer_id END AS wafer_id FROM inline_raw) GROUP BY wafer_id""")
def wafer_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw")
    raw = raw.withColumn("wafer_id", F.when(F.col("item_id") == "error", " bad ").otherwise(F.col("wafer_id")))
    counts = raw.groupBy("wafer_id").agg(F.count("*").alias("n"))
    return counts.select("wafer_id", text.wafer_number("wafer_id").alias("wafer"), "n")


# names with path characters, white space, repeats and line breaks
_NAME = "concat(' ', p_name, ' /:', p_type, '  *<', p_brand, '__', cast(p_size AS string), '..')"


@query("safe_name", f"""WITH names AS (SELECT p_partkey, {_NAME} AS raw_name FROM part)
    SELECT p_partkey,
      rtrim(regexp_replace(regexp_replace(raw_name, '[\\\\/:*?"<>|]+', '_', 'g'), '\\s+', '_', 'g'), '.') AS as_file,
      regexp_replace(regexp_replace(trim(raw_name), '[\\\\/:*?"<>|]', '_', 'g'), '_+', '_', 'g') AS as_label,
      trim(regexp_replace(regexp_replace(trim(raw_name), '[^\\w\\-.]+', '_', 'g'), '_+', '_', 'g'), '_') AS as_column
    FROM names""")
def safe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = bindings.table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_NAME} AS raw_name")
    return names.select(
        "p_partkey", text.file_name("raw_name").alias("as_file"),
        text.label_name("raw_name").alias("as_label"), text.column_name("raw_name").alias("as_column"),
    )


_LABELS = [("Brand#1", "FIRST"), ("Brand#2", "SECOND"), ("Brand#11", "NEVER")]


@query("product_label", """SELECT p_partkey, CASE WHEN contains(p_brand, 'Brand#1') THEN 'FIRST'
      WHEN contains(p_brand, 'Brand#2') THEN 'SECOND' ELSE p_brand END AS "PRODUCT" FROM part""")
def product_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = bindings.table(spark, sf_dir, "part")
    return part.select("p_partkey", text.contains_label("p_brand", _LABELS).alias("PRODUCT"))


@query("knob_blank_cleanup", f"""{FAB_RAW} SELECT arrival, wafer_id,
      CASE WHEN sig IN ('None', 'None_None', 'None_None_None') THEN '' ELSE sig END AS knob
    FROM (SELECT arrival, wafer_id, concat(coalesce(ppid, 'None'), CASE WHEN unit_id = 'A' THEN '' ELSE concat('_', coalesce(chamber_id, 'None')) END) AS sig FROM fab_raw)""")
def knob_blank_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    tail = F.when(F.col("unit_id") == "A", "").otherwise(F.concat(F.lit("_"), F.coalesce("chamber_id", F.lit("None"))))
    signature = F.concat(F.coalesce("ppid", F.lit("None")), tail)
    return raw.select("arrival", "wafer_id", text.blank_none_text(signature).alias("knob"))


@query("sql_fragment", f"""{FAB_RAW} SELECT * FROM (SELECT arrival, wafer_id, step_id, ppid FROM fab_raw) t
    WHERE step_id = 'CC902000' AND ppid LIKE 'PP_A%' ORDER BY arrival, wafer_id, step_id, ppid LIMIT 2000""")
def sql_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw").select("arrival", "wafer_id", "step_id", "ppid")
    return adhoc.view(raw, "step_id = 'CC902000' AND ppid LIKE 'PP_A%' ORDER BY arrival, wafer_id, step_id, ppid", 5000)


_FULL = """SELECT vehicle, step_id, COUNT(*) AS n, COUNT(DISTINCT root_lot_id) AS lots FROM t
    GROUP BY vehicle, step_id ORDER BY n DESC, vehicle, step_id"""


@query("sql_full", f"{FAB_RAW} {_FULL.replace('FROM t', 'FROM fab_raw')} LIMIT 200")
def sql_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adhoc.view(bindings.bound(spark, sf_dir, "fab_raw"), _FULL, 200)


@query("sleuth_fill", f"WITH {FAB_EVENT}{SLEUTH} SELECT arrival, wafer_id, step_id, seq AS sleuth_order FROM sleuth")
def sleuth_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = add_wafer_rank(common.fab_event(spark, sf_dir))
    return event.select("arrival", "wafer_id", "step_id", common.REGISTRY.value("sleuth_order").alias("sleuth_order"))


@query("item_allowlist", f"""WITH {bindings.cte('inline_raw')}, allowed AS (
      SELECT DISTINCT trim(replace(p_name, ' ', '')) AS item_id FROM part WHERE upper(trim(p_type)) = 'ECONOMY'
      UNION SELECT 'click' UNION SELECT 'view')
    SELECT item_id, count(*) AS n, count(value) AS n_values FROM inline_raw WHERE item_id IN (SELECT item_id FROM allowed) GROUP BY item_id""")
def item_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waferline.operators.event import keep_items
    from waferline.sources.rules import allowed_items

    # an item list of every part; only REAL rows count, ids are trimmed
    listed = bindings.table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN upper(trim(p_type)) = 'ECONOMY' THEN ' real' ELSE 'ADDP' END AS CATEGORY",
        "concat(' ', replace(p_name, ' ', ''), ' ') AS ITEMID",
    )
    raw = bindings.bound(spark, sf_dir, "inline_raw")
    measured = raw.select(
        F.when(F.col("item_id").isin("click", "view"), "REAL").otherwise("ADDP").alias("CATEGORY"),
        F.col("item_id").alias("ITEMID"),
    ).distinct()
    kept = keep_items(raw, allowed_items(listed.unionByName(measured)), "item_id")
    return kept.groupBy("item_id").agg(F.count("*").alias("n"), F.count("value").alias("n_values"))
