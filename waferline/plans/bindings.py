"""The source-shaped tables that the registered queries run on.

Each binding is a list of columns written in SQL that Spark and DuckDB both understand, so that a
query and its check see the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waferline.plans import rulebook
from waferline.sources import rules as rule_tables

_STEP = "(CASE WHEN l_partkey % 97 = 0 THEN 12 ELSE cast(l_partkey % 12 AS int) END)"
_VEHICLE_OF_USER = "CASE WHEN user_id % 2 = 0 THEN 'VH_O' ELSE 'VH_F' END"
_DAY = "cast(cast(ts AS date) AS string)"

FAB_RAW = {
    "vehicle": "concat('VH_', l_linestatus)",
    "root_lot_id": "concat(CASE WHEN l_suppkey % 10 = 0 THEN 'Q' ELSE 'R' END, lpad(cast(l_suppkey AS string), 10, '0'))",
    "wafer_id": "cast(l_linenumber AS string)",
    "part_id": "concat(' PART', lpad(cast(l_partkey AS string), 8, '0'), '_', l_returnflag)",
    "tkout_time": f"""CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN ''
        ELSE concat(cast(cast(l_shipdate AS date) + {_STEP} * 3650 AS string), ' ',
                    lpad(cast(l_partkey % 24 AS string), 2, '0'), ':', lpad(cast(l_orderkey % 60 AS string), 2, '0'), ':00') END""",
    "step_id": f"""CASE WHEN {_STEP} = 10 THEN 'CCAUXA' WHEN {_STEP} = 11 THEN 'AX550000'
        ELSE concat('CC', cast(900000 + 1000 * {_STEP} AS string)) END""",
    "step_desc": f"CASE WHEN l_partkey % 5 = 0 THEN 'MEASURE_X' WHEN l_partkey % 43 = 0 THEN NULL ELSE concat('RAW_', cast({_STEP} AS string)) END",
    "ppid": """CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN '' WHEN l_orderkey % 31 = 0 THEN 'skip_run'
        WHEN l_orderkey % 37 = 0 THEN '-' ELSE concat('PP_', l_returnflag, cast(l_orderkey % 2 AS string)) END""",
    "reticle_id": """CASE WHEN l_partkey % 11 = 0 THEN '' WHEN l_partkey % 13 = 0 THEN NULL
        ELSE concat('RT', lpad(cast(l_partkey % 50 AS string), 3, '0')) END""",
    "eqp_id": """CASE WHEN l_partkey % 13 = 0 THEN 'AUX' WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 19 = 0 THEN NULL
        ELSE concat('EQP_', lpad(cast(cast(l_quantity AS int) % 7 AS string), 2, '0')) END""",
    "eqp_model": "CASE WHEN l_orderkey % 7 = 0 THEN 'MEA-1' WHEN l_orderkey % 11 = 0 THEN NULL ELSE concat('GEN-', cast(l_orderkey % 3 AS string)) END",
    "chamber_id": "CASE WHEN l_orderkey % 5 = 0 THEN '-' WHEN l_orderkey % 5 = 1 THEN '' WHEN l_orderkey % 5 = 2 THEN NULL ELSE ' CH' END",
    "unit_id": "CASE WHEN l_orderkey % 7 = 0 THEN '-' WHEN l_orderkey % 7 = 1 THEN 'A' WHEN l_orderkey % 7 = 2 THEN NULL ELSE cast(l_orderkey % 7 AS string) END",
    "sleuth_order": "CASE WHEN l_orderkey % 4 = 0 THEN cast(cast(l_quantity AS int) AS string) WHEN l_orderkey % 4 = 1 THEN '-' WHEN l_orderkey % 4 = 2 THEN '' ELSE NULL END",
    "area": "concat('AREA', cast(l_suppkey % 4 AS string))",
    "split": "concat('Y', substr(cast(cast(l_shipdate AS date) AS string), 1, 4))",
    "arrival": "concat(lpad(cast(l_orderkey AS string), 12, '0'), lpad(cast(l_partkey AS string), 12, '0'), cast(cast(l_shipdate AS date) AS string))",
}

INLINE_RAW = {
    "vehicle": _VEHICLE_OF_USER,
    "root_lot_id": "concat(CASE WHEN user_id % 10 = 0 THEN 'Q' ELSE 'R' END, lpad(cast(user_id AS string), 10, '0'))",
    "wafer_id": f"concat('W', replace({_DAY}, '-', ''))",
    "item_id": "event_type",
    "value": "CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END",
    "measure_pos": "cast(event_id % 5 AS string)",
    "tkout_time": f"concat({_DAY}, ' 00:00:00')",
    "time": "ts",
    "split": f"concat('M', substr({_DAY}, 1, 7))",
}

VM_RAW = {
    "vehicle": _VEHICLE_OF_USER,
    "root_lot_id": INLINE_RAW["root_lot_id"],
    "wafer_id": INLINE_RAW["wafer_id"],
    "sensor_id": "event_type",
    "eqp_id": "concat('EQP_', cast(event_id % 7 AS string))",
    "step_id": "CASE WHEN event_id % 13 = 11 THEN 'AX550000' ELSE concat('CC', cast(900000 + 1000 * (event_id % 10) AS string)) END",
    "predicted_value": "value + 1",
    "actual_value": "value",
    "residual": "CASE WHEN event_id % 47 = 0 THEN NULL ELSE value - 50 END",
    "tkout_time": INLINE_RAW["tkout_time"],
    "time": "ts",
}

# older item events: a description and a sub-item beside the item, the value as text
ITEM_RAW = {
    **{c: INLINE_RAW[c] for c in ("vehicle", "root_lot_id", "wafer_id", "item_id", "time")},
    "step_desc": "concat('STEP_', cast(event_id % 3 AS string))",
    "subitem_id": "CASE WHEN event_id % 5 = 0 THEN 'LIMIT' ELSE 'VALUE' END",
    "fab_value": "CASE WHEN event_id % 19 = 0 THEN '0' WHEN event_id % 59 = 0 THEN '0.0' ELSE cast(value AS string) END",
}

# a run or chunk log: one record per event
LOG = {
    "run_id": "event_id",
    "ts": "ts",
    "vehicle": "concat('U', lpad(cast(user_id AS string), 10, '0'))",
    "date": _DAY,
    "status": """CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'in_progress'
        WHEN 'signup' THEN 'resumed' ELSE NULL END""",
    "ok": "event_type <> 'error'",
    "mode": "CASE WHEN event_id % 3 = 0 THEN 'manual' ELSE 'auto' END",
    "elapsed_sec": "value",
    "line": "CASE WHEN event_id % 41 = 0 THEN substr(props, 1, 4) ELSE props END",
}

# a large rule table, one rule per part
PART_RULES = {
    "feature_name": "p_brand",
    "function_step": "concat(' ', p_type)",
    "rule_order": "CASE WHEN p_size % 10 = 0 THEN 'RO' WHEN p_size % 17 = 0 THEN '' ELSE concat('R', cast(p_size AS string)) END",
    "operator": "CASE WHEN p_partkey % 6 = 0 THEN '_null' WHEN p_partkey % 6 = 1 THEN 'not_null' WHEN p_partkey % 31 = 0 THEN NULL ELSE 'eq' END",
    "value": "CASE WHEN p_partkey % 37 = 0 THEN '' ELSE concat('PP_', p_name) END",
    "category": "CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 'SKIP' ELSE concat('K', cast(p_size AS string)) END",
    "use": "CASE WHEN p_partkey % 11 = 0 THEN 'N' WHEN p_partkey % 3 = 0 THEN ' y' ELSE NULL END",
    "agg": "cast(NULL AS string)",
    "pos": "p_partkey",
}

PART_STEPS = {
    "vehicle": "'VH_P'",
    "step_id": "concat('ST', lpad(cast(p_size AS string), 3, '0'))",
    "step_desc": "p_type",
}

TABLES = {
    "fab_raw": ("lineitem", FAB_RAW),
    "inline_raw": ("events", INLINE_RAW),
    "vm_raw": ("events", VM_RAW),
    "item_raw": ("events", ITEM_RAW),
    "log": ("events", LOG),
    "part_rules": ("part", PART_RULES),
    "part_steps": ("part", PART_STEPS),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.

    A small file has one row group, which one task would read and work on alone. Only where a scan
    has fewer tasks than the cluster has cores, its rows are spread by the first column.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source-shaped table over a driver table."""
    base, columns = TABLES[name]
    return table(spark, sf_dir, base).selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()])


def rules(spark: SparkSession, name: str) -> DataFrame:
    columns, rows = rulebook.BOOK[name]
    return rule_tables.table(spark, columns, rows)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def cte(*names: str) -> str:
    """The named bindings and rule tables as the WITH list of a check query."""
    parts = []
    for name in names:
        if name in TABLES:
            base, columns = TABLES[name]
            body = "SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in columns.items()) + f" FROM {base}"
            parts.append(f"{name} AS ({body})")
        else:
            columns, rows = rulebook.BOOK[name]
            values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
            parts.append(f"{name}({', '.join(columns)}) AS (VALUES {values})")
    return ", ".join(parts)
