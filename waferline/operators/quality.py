"""Data-quality checks in one shape: (vehicle, stage, name, n, status)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferline.functions.text import is_blank
from waferline.operators.ranking import top_rows

# Stages in their order, statuses by gravity, the share of matched steps that is
# fine, and how many problems a digest shows.
STAGES = ("raw", "event", "feature", "send")
GRAVITY = {"ok": 0, "skip": 0, "warn": 1, "fail": 2}
MATCH_OK = 80.0
DIGEST_ROWS = 24
FIX_ROWS = 3

#: What to do about a check that is not ok, by its name. Several checks share one.
FIXES = {
    "rows": "extract the raw rows again",
    "missing_columns": "add the missing columns to the extraction",
    "foreign_dates": "store rows under the date of their time",
    "null_lots": "ask the source for the missing keys",
    "null_wafers": "ask the source for the missing keys",
    "prefix_pct": "check the lot prefix of the vehicle",
    "match_pct": "add the unmapped steps to the step map",
    "event_rows": "rebuild the events",
    "blank_descs": "add the unmapped steps to the step map",
    "family_fab": "name the steps of the rules as the events do",
    "family_knob": "name the steps of the rules as the events do",
    "family_mask": "name the steps of the rules as the events do",
    "family_inline": "name the items of the rules as the events do",
    "family_vm": "name the items of the rules as the events do",
    "coverage_days": "rebuild the features",
    "wide_rows": "rebuild the wide table",
    "published_rows": "publish the wide table again",
    "send_knob": "send the groups again",
    "send_fab": "send the groups again",
    "send_vm": "send the groups again",
    "send_inline": "send the groups again",
}


def _ok_else(test: Column, status: str) -> Column:
    return F.when(test, "ok").otherwise(status)


def _as_checks(df: DataFrame, keys: list[str], stage: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """One row per check from a row of numbers."""
    cells = [
        F.struct(F.lit(name).alias("name"), F.col(n).cast("double").alias("n"), status.alias("status"))
        for name, n, status in checks
    ]
    rows = df.select(*keys, F.lit(stage).alias("stage"), F.explode(F.array(*cells)).alias("c"))
    return rows.select(*keys, "stage", "c.name", "c.n", "c.status")


def raw_checks(raw: DataFrame, keys: list[str], time: str, date: str, missing: list[str]) -> DataFrame:
    """Rows, configured columns that did not arrive, rows of other dates, and null keys."""
    foreign = F.substring(F.col(time), 1, 10) != F.col(date)
    sums = raw.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.lit(len(missing)).alias("n_missing"),
        F.sum(F.coalesce(foreign, F.lit(False)).cast("int")).alias("n_foreign"),
        F.sum(F.col("root_lot_id").isNull().cast("int")).alias("null_lots"),
        F.sum(F.col("wafer_id").isNull().cast("int")).alias("null_wafers"),
    )
    return _as_checks(sums, keys, "raw", [
        ("rows", "n_rows", _ok_else(F.col("n_rows") > 0, "fail")),
        ("missing_columns", "n_missing", _ok_else(F.col("n_missing") == 0, "warn")),
        ("foreign_dates", "n_foreign", _ok_else(F.col("n_foreign") == 0, "warn")),
        ("null_lots", "null_lots", _ok_else(F.col("null_lots") == 0, "warn")),
        ("null_wafers", "null_wafers", _ok_else(F.col("null_wafers") == 0, "warn")),
    ])


def event_checks(raw: DataFrame, event: DataFrame, step_map: DataFrame, prefix: str) -> DataFrame:
    """Lot prefix hits, share of matched steps, event rows and blank descriptions per vehicle."""
    keys = ["vehicle"]
    hits = raw.groupBy(*keys).agg(
        F.round(F.avg(F.col("root_lot_id").startswith(prefix).cast("double")) * 100, 6).alias("prefix_pct")
    )
    mapped = step_map.select("vehicle", "step_id", F.lit(1).alias("mapped")).distinct()
    steps = raw.where(~is_blank("step_id")).select("vehicle", F.trim("step_id").alias("step_id")).distinct()
    share = steps.join(mapped, ["vehicle", "step_id"], "left").groupBy(*keys).agg(
        F.round(F.count("mapped") / F.count("*") * 100, 6).alias("match_pct")
    )
    rows = event.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.sum(is_blank("step_desc").cast("int")).alias("blank_descs")
    )
    sums = hits.join(share, keys, "left").join(rows, keys, "left").fillna(0)
    match = F.when(F.col("match_pct") >= MATCH_OK, "ok").when(F.col("match_pct") > 0, "warn").otherwise("fail")
    blank = F.when(F.col("blank_descs") == 0, "ok").when(F.col("blank_descs") < F.col("n_rows"), "warn")
    return _as_checks(sums, keys, "event", [
        ("prefix_pct", "prefix_pct", _ok_else(F.col("prefix_pct") > 0, "fail")),
        ("match_pct", "match_pct", match),
        ("event_rows", "n_rows", _ok_else(F.col("n_rows") > 0, "fail")),
        ("blank_descs", "blank_descs", blank.otherwise("fail")),
    ])


def feature_checks(rules: DataFrame, long: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Rules against produced features per vehicle and family: rules without any feature fail.

    ``rules`` has category and feature, one row per rule.
    """
    wanted = rules.groupBy("category").agg(F.count("*").alias("n_rules"))
    made = long.select("vehicle", "category", "feature").distinct()
    made = made.groupBy("vehicle", "category").agg(F.count("*").alias("n_features"))
    # a vehicle meets each family through its own list, not through a cross product of rows
    families = F.array(*[F.lit(c) for c in ("FAB", "KNOB", "MASK", "INLINE", "VM")])
    grid = vehicles.select("vehicle", F.explode(families).alias("category"))
    sums = grid.join(wanted, "category").join(made, ["vehicle", "category"], "left").fillna(0, ["n_features"])
    status = _ok_else((F.col("n_features") > 0) | (F.col("n_rules") == 0), "fail")
    return sums.select(
        "vehicle", F.lit("feature").alias("stage"), F.concat(F.lit("family_"), F.lower("category")).alias("name"),
        F.col("n_features").cast("double").alias("n"), status.alias("status"),
    )


def product_checks(vehicles: DataFrame, covered: DataFrame, built: DataFrame, published: DataFrame) -> DataFrame:
    """Days that the features cover, rows of the wide table and of its published copy, per vehicle.

    ``covered`` has (vehicle, days), ``built`` and ``published`` have (vehicle, n_rows, written), a row a vehicle
    at most. A copy older than the wide table is a warning, as are features without a day; a table that is
    missing or empty fails.
    """
    sums = vehicles.select("vehicle").distinct().join(covered.select("vehicle", "days"), "vehicle", "left")
    for name, table in (("built", built), ("published", published)):
        own = table.select("vehicle", F.col("n_rows").alias(f"{name}_rows"), F.col("written").alias(f"{name}_at"))
        sums = sums.join(own, "vehicle", "left")
    sums = sums.fillna(0, ["days", "built_rows", "published_rows"])
    copy = F.when(F.col("published_at") < F.col("built_at"), "warn").otherwise(_ok_else(F.col("published_rows") > 0, "fail"))
    return _as_checks(sums, ["vehicle"], "feature", [
        ("coverage_days", "days", _ok_else(F.col("days") > 0, "warn")),
        ("wide_rows", "built_rows", _ok_else(F.col("built_rows") > 0, "fail")),
        ("published_rows", "published_rows", copy),
    ])


def send_checks(vehicle: str, wide_columns: list[str], groups: dict[str, list[str]],
                prefixes: dict[str, tuple[str, ...]]) -> list[tuple]:
    """Wide columns a send group lacks, per group: rows of (vehicle, stage, name, n, status)."""
    out = []
    for group, have in groups.items():
        wanted = [c for c in wide_columns if c.startswith(prefixes[group])]
        absent = len(set(wanted) - set(have))
        status = "skip" if not wanted else "fail" if absent else "ok"
        out.append((vehicle, "send", f"send_{group.lower()}", float(absent), status))
    return out


def gravity() -> Column:
    out = F.lit(0)
    for status, rank in GRAVITY.items():
        out = F.when(F.col("status") == status, rank).otherwise(out)
    return out


def stage_order() -> Column:
    out = F.lit(len(STAGES))
    for i, stage in enumerate(STAGES):
        out = F.when(F.col("stage") == stage, i).otherwise(out)
    return out


def _name(rank: Column) -> Column:
    return F.when(rank == 2, "fail").when(rank == 1, "warn").otherwise("ok")


def summary(checks: DataFrame) -> DataFrame:
    """Per vehicle and stage the worst status and counts; the vehicle's first failing stage."""
    ranked = checks.withColumn("gravity", gravity())
    stages = ranked.groupBy("vehicle", "stage").agg(
        F.max("gravity").alias("worst"), F.sum((F.col("gravity") == 2).cast("int")).alias("failed"),
        F.sum((F.col("gravity") == 1).cast("int")).alias("warned"),
        F.min((F.col("status") == "skip").cast("int")).alias("skipped"),
    )
    first = F.min(F.when(F.col("worst") == 2, F.struct(stage_order().alias("o"), "stage")))["stage"]
    vehicles = stages.groupBy("vehicle").agg(_name(F.max("worst")).alias("overall"), first.alias("blocked_at"))
    status = F.when(F.col("skipped") == 1, "skip").otherwise(_name(F.col("worst")))
    return stages.select("vehicle", "stage", status.alias("status"), "failed", "warned").join(vehicles, "vehicle")


def digest(checks: DataFrame, n: int = DIGEST_ROWS) -> DataFrame:
    """Fails, then warnings, of each vehicle in stage order, at most ``n``."""
    problems = checks.where(F.col("status").isin("fail", "warn"))
    order = [(F.col("status") != "fail").cast("int"), stage_order(), F.col("name")]
    return top_rows(problems, ["vehicle"], order, n)


def fixes(checks: DataFrame, n: int = FIX_ROWS) -> DataFrame:
    """The first ``n`` different fixes of each vehicle in the order of its digest, with the problems each is for."""
    fix = F.create_map(*[F.lit(x) for pair in FIXES.items() for x in pair])[F.col("name")]
    rows = digest(checks).select("vehicle", F.col("rank").alias("first"), fix.alias("fix")).where("fix IS NOT NULL")
    rows = rows.groupBy("vehicle", "fix").agg(F.min("first").alias("first"), F.count("*").alias("n_problems"))
    return top_rows(rows, ["vehicle"], [F.col("first")], n).drop("first")
