"""Queries over partitions, extraction units, rule files and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.operators import runs
from waferline.plans import bindings, rulebook
from waferline.plans.registry import query
from waferline.session import run_dir
from waferline.sources import extract, partitions
from waferline.sources import rules as rule_tables
from waferline.sources.schema import FAB, INLINE, drift_union

TODAY = rulebook.TODAY


def write_inline(spark: SparkSession, sf_dir: str) -> str:
    """INLINE raw of both vehicles as source/vehicle/date partitions."""
    root = run_dir(spark)
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    for vehicle in rulebook.VEHICLES:
        partitions.write(raw.where(F.col("vehicle") == vehicle), root, INLINE, vehicle, TODAY)
    return root


_INLINE = "WITH " + bindings.cte("inline_raw")


@query("scan_partitions", f"""{_INLINE} SELECT root_lot_id, wafer_id, item_id, value, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, substr(tkout_time, 1, 10) AS date
    FROM inline_raw WHERE vehicle = 'VH_O' AND substr(tkout_time, 1, 10) > '2024-01-18'""")
def scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = partitions.scan(spark, write_inline(spark, sf_dir), INLINE, "VH_O", last_days=14, today=TODAY)
    return rows.select("root_lot_id", "wafer_id", "item_id", "value", "time", "date")


_FAB = "WITH " + bindings.cte("fab_raw")


@query("drift_union", f"""{_FAB} SELECT wafer_id, step_id, CASE WHEN split < 'Y1997' THEN NULL ELSE tkout_time END AS tkout_time,
      CASE WHEN split >= 'Y1999' THEN NULL ELSE ppid END AS ppid, count(*) AS n FROM fab_raw GROUP BY ALL""")
def drift_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # days of three shapes: no time column, a number for a text, no recipe column
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    early = raw.where("split < 'Y1997'").drop("tkout_time").withColumn("wafer_id", F.col("wafer_id").cast("bigint"))
    middle = raw.where("split >= 'Y1997' AND split < 'Y1999'")
    late = raw.where("split >= 'Y1999'").drop("ppid").withColumn("odd", F.lit(1))
    rows = drift_union([early, middle, late], FAB.schema)
    return rows.groupBy("wafer_id", "step_id", "tkout_time", "ppid").agg(F.count("*").alias("n"))


@query("missing_columns", f"""{_FAB}, shown AS (SELECT vehicle, step_id, count(CASE WHEN vehicle = 'VH_F' THEN NULL ELSE sleuth_order END) AS sleuth_order,
      count(CASE WHEN step_id = 'CCAUXA' THEN NULL ELSE ppid END) AS ppid, count(eqp_id) AS eqp_id FROM fab_raw GROUP BY ALL)
    SELECT vehicle, step_id, "column" FROM (UNPIVOT shown ON sleuth_order, ppid, eqp_id INTO NAME "column" VALUE n) WHERE n = 0""")
def missing_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    raw = raw.withColumn("sleuth_order", F.when(F.col("vehicle") != "VH_F", F.col("sleuth_order")))
    raw = raw.withColumn("ppid", F.when(F.col("step_id") != "CCAUXA", F.col("ppid")))
    wanted = ["sleuth_order", "ppid", "eqp_id"]
    return partitions.never_filled(raw, ["vehicle", "step_id"], wanted)


@query("rules_read", """SELECT p_brand AS feature_name, p_type AS function_step, cast(p_size AS varchar) AS rule_order,
      CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS value, cast(NULL AS varchar) AS agg FROM part""")
def rules_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_dir(spark)}/rules"
    part = bindings.table(spark, sf_dir, "part").selectExpr(
        "p_brand AS feature_name", "p_type AS function_step", "p_size AS rule_order",
        "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS value",
    )
    part.write.option("header", True).csv(path)
    return rule_tables.read_csv(spark, path, ["feature_name", "function_step", "rule_order", "value", "agg"])


_PROBE = "SELECT DISTINCT root_lot_id FROM fab_raw WHERE split = 'Y1998'"


@query("key_batch_fetch", f"""{_FAB}, batches AS (SELECT root_lot_id, (row_number() OVER (ORDER BY root_lot_id) - 1) // 40 AS batch FROM ({_PROBE}))
    SELECT batch, count(DISTINCT root_lot_id) AS n_keys, count(*) AS n_rows, min(arrival) AS first_row FROM fab_raw JOIN batches USING (root_lot_id) GROUP BY batch""")
def key_batch_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    probe = raw.where("split = 'Y1998'").select(F.lit("FAB").alias("source"), "root_lot_id").distinct()
    batches = extract.key_batches(probe, "source", "root_lot_id", 40)
    rows = extract.rows_of_keys(raw, probe, "root_lot_id").join(batches, "root_lot_id")
    return rows.groupBy("batch").agg(
        F.count_distinct("root_lot_id").alias("n_keys"), F.count("*").alias("n_rows"), F.min("arrival").alias("first_row")
    )


@query("split_windows", f"""WITH units AS (SELECT s_suppkey, 3 + s_nationkey AS span, 1 + s_nationkey % 4 AS split FROM supplier),
    starts AS (SELECT s_suppkey, split, unnest(range(-span, 0, split)) AS off FROM units UNION ALL SELECT s_suppkey, split, 0 FROM units)
    SELECT s_suppkey, cast(DATE '{TODAY}' + cast(off AS int) AS varchar) AS "start",
      cast(DATE '{TODAY}' + cast(CASE WHEN off < 0 THEN least(off + split, 0) ELSE 1 END AS int) AS varchar) AS "end" FROM starts""")
def split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = bindings.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "3 + s_nationkey AS span", "1 + s_nationkey % 4 AS split"
    )
    out = extract.windows(units, TODAY, "span", "split")
    return out.select("s_suppkey", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"))


@query("backfill_grid", f"""SELECT s_name AS product, source, s_nationkey AS priority, cast(DATE '{TODAY}' - cast(back AS int) AS varchar) AS date
    FROM (SELECT *, unnest(range(0, CASE WHEN s_nationkey % 5 = 0 THEN 3 ELSE s_nationkey % 5 + 6 END + 1)) AS back FROM supplier),
      (VALUES ('FAB'), ('INLINE'), ('VM')) AS v(source)""")
def backfill_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = bindings.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("product"), F.explode(F.array(F.lit("FAB"), F.lit("INLINE"), F.lit("VM"))).alias("source"),
        F.col("s_nationkey").alias("priority"),
        F.when(F.col("s_nationkey") % 5 != 0, F.col("s_nationkey") % 5 + 6).alias("override_days"),
    )
    grid = extract.backfill(units, TODAY, 3).orderBy(*extract.backfill_order())
    return grid.withColumn("date", F.col("date").cast("string"))


@query("date_partition", f"""{_FAB} SELECT vehicle, coalesce(nullif(substr(tkout_time, 1, 10), ''), '{TODAY}') AS date, count(*) AS n FROM fab_raw GROUP BY ALL""")
def date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "fab_raw")
    date = partitions.partition_date(FAB.partition_time(), TODAY)
    return raw.groupBy("vehicle", date.alias("date")).agg(F.count("*").alias("n"))


@query("retention_expired", f"""{_INLINE} SELECT vehicle, substr(tkout_time, 1, 10) AS date, count(*) AS n FROM inline_raw
    WHERE cast(substr(tkout_time, 1, 10) AS date) < DATE '{TODAY}' - 6 GROUP BY ALL""")
def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw")
    dates = raw.groupBy("vehicle", F.substring("tkout_time", 1, 10).alias("date")).agg(F.count("*").alias("n"))
    return partitions.expired(dates, 7, TODAY)


_MANIFEST = "vehicle, substr(tkout_time, 1, 10) AS date, max(time) AS written"


@query("stale_partitions", f"""{_INLINE}, raw AS (SELECT {_MANIFEST} FROM inline_raw GROUP BY ALL),
    built AS (SELECT {_MANIFEST}, CASE WHEN count(*) % 3 = 0 THEN 'v1' ELSE 'v2' END AS version FROM inline_raw WHERE item_id = 'click' GROUP BY ALL)
    SELECT raw.vehicle, raw.date, CASE WHEN built.date IS NULL THEN 'missing' WHEN version <> 'v2' THEN 'version' ELSE 'newer raw' END AS reason
    FROM raw LEFT JOIN built USING (vehicle, date) WHERE built.date IS NULL OR version <> 'v2' OR built.written < raw.written""")
def stale_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("date", F.substring("tkout_time", 1, 10))
    keys = ["vehicle", "date"]
    written = raw.groupBy(*keys).agg(F.max("time").alias("written"))
    version = F.when(F.count("*") % 3 == 0, "v1").otherwise("v2").alias("version")
    built = raw.where("item_id = 'click'").groupBy(*keys).agg(F.max("time").alias("written"), version)
    return partitions.stale_partitions(written, built, keys, "v2").select(*keys, "reason")


@query("pending_partitions", f"""{_INLINE}, raw AS (SELECT vehicle, item_id AS source, substr(tkout_time, 1, 10) AS date, count(*) AS n FROM inline_raw GROUP BY ALL),
    built AS (SELECT DISTINCT vehicle, source, date FROM raw WHERE n > 3)
    SELECT vehicle, source, count(*) AS n_raw, count(built.date) AS n_event, count(*) - count(built.date) AS n_pending, max(raw.date) AS newest_raw
    FROM raw LEFT JOIN built USING (vehicle, source, date) GROUP BY ALL""")
def pending_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("date", F.substring("tkout_time", 1, 10))
    raw = raw.groupBy("vehicle", F.col("item_id").alias("source"), "date").agg(F.count("*").alias("n"))
    return partitions.pending(raw.drop("n"), raw.where("n > 3").drop("n"), ["vehicle", "source"])


_CONTENT = ["root_lot_id", "wafer_id", "item_id", "measure_pos"]
_DIGEST = f"""cast('0x' || substr(md5(concat_ws('|', {', '.join(f"coalesce(length({c}) || ':' || {c}, '~')" for c in _CONTENT)})), 1, 15) AS bigint)"""


@query("partition_fingerprint", f"""{_INLINE} SELECT vehicle, substr(tkout_time, 1, 10) AS date, count(*) AS n_rows, cast(sum({_DIGEST}) AS varchar) AS content
    FROM inline_raw GROUP BY ALL""")
def partition_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("date", F.substring("tkout_time", 1, 10))
    return partitions.fingerprints(raw, ["vehicle", "date"], _CONTENT)


@query("partition_changed", f"""{_INLINE}, prints AS (SELECT vehicle, substr(tkout_time, 1, 10) AS date, count(*) AS n_rows, cast(sum({_DIGEST}) AS varchar) AS content FROM inline_raw GROUP BY ALL),
    stored AS (SELECT vehicle, substr(tkout_time, 1, 10) AS date, count(*) AS n_rows, cast(sum({_DIGEST}) AS varchar) AS content FROM inline_raw WHERE root_lot_id <> 'R0000000007' GROUP BY ALL)
    SELECT p.* FROM prints p LEFT JOIN stored s USING (vehicle, date) WHERE s.content IS DISTINCT FROM p.content OR s.n_rows IS DISTINCT FROM p.n_rows""")
def partition_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("date", F.substring("tkout_time", 1, 10))
    stored = partitions.fingerprints(raw.where("root_lot_id <> 'R0000000007'"), ["vehicle", "date"], _CONTENT)
    return partitions.changed(partitions.fingerprints(raw, ["vehicle", "date"], _CONTENT), stored, ["vehicle", "date"])


def write_layers(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """INLINE raw and its events, each as partitions, by layer."""
    root, event_root = write_inline(spark, sf_dir), run_dir(spark)
    kept = partitions.scan(spark, root, INLINE).where(F.col("root_lot_id").startswith(rulebook.LOT_PREFIX))
    partitions.overwrite_partitions(kept, event_root, partitions.PARTITIONS)
    return {"raw": root, "event": event_root}


_DATES = "count(DISTINCT substr(tkout_time, 1, 10)) AS dates, min(substr(tkout_time, 1, 10)) AS first_date, max(substr(tkout_time, 1, 10)) AS last_date"


@query("storage_rollup")
def storage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.storage_by_layer(spark, write_layers(spark, sf_dir), 100_000)


@query("storage_dates", f"""{_INLINE} SELECT 'raw' AS layer, 'INLINE' AS source, vehicle, {_DATES} FROM inline_raw GROUP BY vehicle
    UNION ALL SELECT 'event', 'INLINE', vehicle, {_DATES} FROM inline_raw WHERE starts_with(root_lot_id, 'R') GROUP BY vehicle""")
def storage_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = partitions.storage_by_layer(spark, write_layers(spark, sf_dir), 100_000)
    return found.select("layer", "source", "vehicle", "dates", "first_date", "last_date")


_RUNS = """days AS (SELECT vehicle, substr(tkout_time, 1, 10) AS date, count(*) AS n, count(*) FILTER (WHERE starts_with(root_lot_id, 'R') AND item_id = 'click') AS kept FROM inline_raw GROUP BY ALL)"""


@query("refresh_changed", f"""{_INLINE}, {_RUNS} SELECT 1 AS run, 'INLINE' AS source, vehicle, date, 'missing' AS reason, kept AS n_rows FROM days
    UNION ALL SELECT 3, 'INLINE', vehicle, date, 'newer raw', kept FROM days WHERE date > '2024-01-20'
    UNION ALL SELECT 4, 'INLINE', vehicle, date, 'version', n2 FROM (SELECT vehicle, substr(tkout_time, 1, 10) AS date,
      count(*) FILTER (WHERE starts_with(root_lot_id, 'R') AND item_id IN ('click', 'view')) AS n2 FROM inline_raw GROUP BY ALL)""")
def refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four refreshes: of everything, of nothing, of rewritten dates, and after a rule change."""
    from waferline.plans.full_run import Rules, Run

    base = run_dir(spark)
    raw = bindings.bound(spark, sf_dir, "inline_raw").withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    rules = Rules(step_map=[], inline=[{"item_id": "click"}], lot_prefix=rulebook.LOT_PREFIX)
    more = Rules(step_map=[], inline=[{"item_id": "click"}, {"item_id": "view"}], lot_prefix=rulebook.LOT_PREFIX)
    out = None
    for number, (own, days) in enumerate([(rules, "true"), (rules, "false"), (rules, "tkout_time > '2024-01-20 99'"), (more, "false")], 1):
        run = Run(spark, base, own)
        for vehicle in rulebook.VEHICLES:
            run.add_raw(INLINE, vehicle, raw.where(F.col("vehicle") == vehicle).where(days).drop("vehicle"), TODAY)
        built = run.refresh_events(INLINE).select(F.lit(number).alias("run"), *partitions.PARTITIONS, "reason", "n_rows")
        out = built if out is None else out.unionByName(built)
    return out


@query("log_read", f"""WITH {bindings.cte('log')} SELECT run_id, vehicle, cast(json_extract_string(line, '$.k') AS bigint) AS k FROM log WHERE json_valid(line)""")
def log_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.bound(spark, sf_dir, "log").select("run_id", "vehicle", "line")
    return runs.parse_log(lines, "line", T.StructType([T.StructField("k", T.LongType())]))


@query("shard_plan", f"""{_FAB}, counts AS (SELECT vehicle, root_lot_id, count(*) AS n FROM fab_raw GROUP BY ALL),
    sized AS (SELECT *, sum(n) OVER (PARTITION BY vehicle) AS est, count(*) OVER (PARTITION BY vehicle) AS shards,
        row_number() OVER (PARTITION BY vehicle ORDER BY root_lot_id) - 1 AS position FROM counts),
    planned AS (SELECT *, greatest(1, least(cast(ceil(est / 700.0) AS bigint), shards)) AS n_chunks FROM sized)
    SELECT vehicle, root_lot_id, n_chunks, position % n_chunks AS chunk, cast(est // n_chunks AS bigint) AS expected_rows FROM planned""")
def shard_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.shard_plan(bindings.bound(spark, sf_dir, "fab_raw"), ["vehicle"], "root_lot_id", 700)

