"""Queries over the wide wafer table, publishing and sending."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.operators import features, wide
from waferline.operators.ranking import running_total
from waferline.plans import bindings, common, rulebook
from waferline.plans.common import FAB_EVENT, LONG
from waferline.plans.registry import query
from waferline.session import cut_lineage
from waferline.sources import rules as rule_tables


def feature_names() -> tuple[list[str], list[str]]:
    """Text and number features the rules can make, known without reading data."""
    fab, _, _ = features.fab_rules(rulebook.dicts("fab_rules"), common.REGISTRY)
    mask, _ = features.mask_rules(rulebook.dicts("mask_rules"), common.REGISTRY)
    inline, _ = features.number_rules(rulebook.dicts("inline_rules"), "INLINE", common.REGISTRY)
    vm, _ = features.number_rules(rulebook.dicts("vm_rules"), "VM", common.REGISTRY)
    steps = {r["step_desc"] for r in rulebook.dicts("step_map")}
    mapped = {r["function_step"] for r in rulebook.dicts("knob_rules") if r["operator"] == "eq"}
    knob = [f"KNOB_{s}_ppid" for s in sorted(steps & mapped)]
    return [r.feature for r in fab + mask] + knob, [r.feature for r in inline + vm]


def wide_table(spark: SparkSession, sf_dir: str, products: DataFrame) -> DataFrame:
    """Features to one row per wafer, without the columns that have no value."""
    long = cut_lineage(common.long_features(spark, sf_dir))  # read twice: columns, then cells
    filled = set(wide.filled_features(long))
    text, numbers = feature_names()
    return wide.pivot(long, [f for f in text if f in filled], [f for f in numbers if f in filled], products)


def product_table(spark: SparkSession) -> DataFrame:
    return bindings.rules(spark, "products").withColumnRenamed("product_name", "PRODUCT")


def one_product(spark: SparkSession) -> DataFrame:
    """Both vehicles in one product, so that a wafer can occur twice."""
    return rule_tables.table(spark, ["vehicle", "PRODUCT"], [(v, "P_ALL") for v in rulebook.VEHICLES])


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


_UNMADE = ("FAB_NO_SUCH_STEP_eqp_id", "INLINE_nothing_mean", "KNOB_GATE_STACK_ppid")  # rules that meet no rows
_TEXT, _NUMBERS = ([n for n in names if n not in _UNMADE] for names in feature_names())
_WAFER_ID = "try_cast(nullif(regexp_replace(trim(wafer_id), '\\D', '', 'g'), '') AS bigint)"


def _wide_sql(text: list[str], numbers: list[str], product: str) -> str:
    cells = [f"""max(value_str) FILTER (WHERE feature = '{f}') AS "{f}\"""" for f in text]
    cells += [f"""round(max(value_num) FILTER (WHERE feature = '{f}'), 6) AS "{f}\"""" for f in numbers]
    return f"""wide AS (SELECT vehicle, {product} AS "PRODUCT", trim(root_lot_id) AS "ROOT_LOT_ID", {_WAFER_ID} AS "WAFER_ID", {', '.join(cells)}
      FROM long GROUP BY 1, 2, 3, 4)"""


_PRODUCT = "CASE vehicle WHEN 'VH_O' THEN 'P_ALPHA' ELSE 'P_BETA' END"
_LATEST = """SELECT * EXCLUDE (vehicle) FROM wide
    QUALIFY row_number() OVER (PARTITION BY "PRODUCT", "ROOT_LOT_ID", "WAFER_ID" ORDER BY vehicle DESC) = 1"""


@query("base_keys", f"""WITH {LONG} SELECT DISTINCT vehicle, trim(root_lot_id) AS "ROOT_LOT_ID", {_WAFER_ID} AS "WAFER_ID" FROM long""")
def base_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.base_keys(common.long_features(spark, sf_dir))


@query("wide_table", f"WITH {LONG}, {_wide_sql(_TEXT, _NUMBERS, _PRODUCT)} SELECT * FROM wide")
def wide_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(wide_table(spark, sf_dir, product_table(spark)))


@query("publish_product", f"WITH {LONG}, {_wide_sql(_TEXT, _NUMBERS, chr(39) + 'P_ALL' + chr(39))} {_LATEST}")
def publish_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = wide_table(spark, sf_dir, one_product(spark))
    return _rounded(wide.keep_last(table, wide.WIDE_KEY, ["vehicle"]).drop("vehicle"))


def _send_query(group: str) -> None:
    prefixes = wide.SEND_GROUPS[group]
    text = [f for f in _TEXT if f.startswith(prefixes)]
    numbers = [f for f in _NUMBERS if f.startswith(prefixes)]

    @query(f"send_{group.lower()}", f"WITH {LONG}, {_wide_sql(text, numbers, chr(39) + 'P_ALL' + chr(39))} {_LATEST}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = wide.keep_last(wide_table(spark, sf_dir, one_product(spark)), wide.WIDE_KEY, ["vehicle"])
        return _rounded(wide.send(table, group))


for _group in wide.SEND_GROUPS:
    _send_query(_group)


@query("nonnull_counts", f"""WITH {LONG} SELECT feature AS "column", count(*) AS n FROM (
      SELECT DISTINCT vehicle, trim(root_lot_id) AS lot, {_WAFER_ID} AS wafer, feature FROM long WHERE value_str IS NOT NULL OR value_num IS NOT NULL)
    GROUP BY feature""")
def nonnull_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = wide_table(spark, sf_dir, product_table(spark))
    return wide.nonnull_counts(table, [c for c in table.columns if c not in ("vehicle", *wide.WIDE_KEY)])


_NAMES = """concat(CASE p_partkey % 7 WHEN 0 THEN 'KNOB_' WHEN 1 THEN 'FAB_' WHEN 2 THEN 'MASK_' WHEN 3 THEN 'INLINE_' WHEN 4 THEN 'VM_' ELSE 'X_' END,
      CASE WHEN p_partkey % 3 = 0 THEN 'A' ELSE concat(cast(p_size AS string), '.', cast(p_partkey % 10 AS string), ' ') END, p_name, cast(p_partkey AS string))"""


@query("wide_column_order", f"""WITH names AS (SELECT {_NAMES} AS name FROM part), keyed AS (
      SELECT name, CASE WHEN starts_with(name, 'KNOB_') THEN 0 WHEN starts_with(name, 'FAB_') THEN 1 WHEN starts_with(name, 'MASK_') THEN 2
        WHEN starts_with(name, 'INLINE_') THEN 3 WHEN starts_with(name, 'VM_') THEN 4 ELSE 5 END AS family,
      coalesce(try_cast(nullif(regexp_extract(regexp_replace(name, '^(KNOB|FAB|MASK|INLINE|VM)_', ''), '\\d+(?:\\.\\d+)?', 0), '') AS double), 'Infinity'::double) AS number FROM names)
    SELECT name, row_number() OVER (ORDER BY family, number, name) AS position FROM keyed""")
def wide_column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = bindings.table(spark, sf_dir, "part").selectExpr(f"{_NAMES} AS name")
    family, number = wide.column_order_key("name")
    keyed = names.select("name", family.alias("family"), number.alias("number"))
    return running_total(keyed, [], ["family", "number", "name"], F.lit(1), "position").select("name", "position")


@query("dedupe_keep_last", f"""WITH {FAB_EVENT} SELECT root_lot_id, wafer_id, vehicle, tkout_time, arrival, ppid FROM event
    QUALIFY row_number() OVER (PARTITION BY root_lot_id, wafer_id ORDER BY vehicle DESC, tkout_time DESC NULLS LAST, arrival DESC) = 1""")
def dedupe_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.fab_event(spark, sf_dir).select("root_lot_id", "wafer_id", "vehicle", "tkout_time", "arrival", "ppid")
    return wide.keep_last(rows, ["root_lot_id", "wafer_id"], ["vehicle", "tkout_time", "arrival"])
