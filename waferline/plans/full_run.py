"""One run over all stages: raw partitions, events, features, wide table, publishing and scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.functions.registry import Registry
from waferline.operators import event as events
from waferline.operators import features, knob, quality, scan, skip, wide
from waferline.operators.features import WAFER
from waferline.session import cut_lineage
from waferline.sources import partitions
from waferline.sources import rules as rule_tables
from waferline.sources.commits import CommitLog, replace_partitions, replace_table
from waferline.sources.schema import FAB, INLINE, SOURCES, VM, Source


@dataclass
class Rules:
    """The rule tables of a run, each a list of dicts, and its settings."""

    step_map: list[dict]
    fab: list[dict] = field(default_factory=list)
    knob: list[dict] = field(default_factory=list)
    mask: list[dict] = field(default_factory=list)
    inline: list[dict] = field(default_factory=list)
    vm: list[dict] = field(default_factory=list)
    products: dict[str, str] = field(default_factory=dict)
    lot_prefix: str = ""
    keep_days: int = 0
    exclude_eqp: list[str] = field(default_factory=list)
    exclude_model: list[str] = field(default_factory=list)
    hints: dict = field(default_factory=dict)
    hint_columns: tuple[str, ...] = ("ppid", "eqp_id", "eqp_model", "area")
    registry: Registry = field(default_factory=Registry)

    def frame(self, spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
        rows = getattr(self, name)
        return rule_tables.table(spark, columns, [tuple(r.get(c) for c in columns) for r in rows])

    def steps(self, spark: SparkSession) -> DataFrame:
        columns = ["vehicle", "step_id", "step_desc", "pos"]
        rows = [(r["vehicle"], r["step_id"], r["step_desc"], i) for i, r in enumerate(self.step_map)]
        table = rule_tables.table(spark, columns, rows)
        bad = rule_tables.on_driver(rule_tables.conflicts(table, ["vehicle", "step_id"]))
        if bad:
            raise ValueError(f"step map: several descriptions for {', '.join(r['step_id'] for r in bad[:10])}")
        return rule_tables.unique_steps(table, ["vehicle", "step_id"])

    def knob_rules(self, spark: SparkSession) -> DataFrame:
        columns = [*knob.RULE_COLUMNS, "pos"]
        rows = [(*[r.get(c) for c in knob.RULE_COLUMNS], i) for i, r in enumerate(self.knob)]
        return rule_tables.table(spark, columns, rows)


class Run:
    """Stages over one root folder. Each stage reads what the stage before has written."""

    def __init__(self, spark: SparkSession, root: str, rules: Rules):
        self.spark, self.root, self.rules = spark, root, rules

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def add_raw(self, source: Source, vehicle: str, rows: DataFrame, fallback: str) -> bool:
        return partitions.write(rows, self.path("raw"), source, vehicle, fallback)

    def raw(self, source: Source) -> DataFrame:
        return partitions.scan(self.spark, self.path("raw"), source)

    def version(self, source: Source) -> str:
        """Version of all that shapes the events of a source; a rule of another source is no part of it."""
        matched = self.rules.step_map if source.match == "step" else self.rules.inline if source.match == "item" else []
        return partitions.settings_version({
            "matched": matched, "prefix": self.rules.lot_prefix, "match": [source.match, source.item_col], "columns": source.columns,
        })

    def log(self, layer: str, keys: list[str]) -> CommitLog:
        return CommitLog(self.spark, self.path(f"_commits/{layer}"), keys)

    def report(self, name: str, rows: DataFrame) -> None:
        """A report as JSON lines, replaced as a whole; one without rows is an empty folder."""
        rows.write.mode("overwrite").json(self.path(f"reports/{name}"))

    def stale_events(self, source: Source) -> DataFrame:
        """(source, vehicle, date, written, reason) of raw partitions that a refresh would rebuild."""
        keys = partitions.PARTITIONS
        written = partitions.file_times(self.spark, self.path("raw")).where(F.col("source") == source.name)
        known = self.log("event", keys).snapshot().where(F.col("source") == source.name)
        return partitions.stale_partitions(written, known, keys, self.version(source)).select(*keys, "written", "reason")

    def refresh_events(self, source: Source) -> DataFrame:
        """Rebuild the dates whose raw is newer than their event, or all of them after a rule change.

        What a date was built from stands in the commit log: its raw's newest file time and the version of
        the rules. A date that yields no rows any more loses its folder; so does, after a rule change, an
        event whose raw is gone. Returns the rebuilt (source, vehicle, date, reason, n_rows); raw dates
        without a single lot id are the report ``keyless_<source>``.
        """
        keys = partitions.PARTITIONS
        log, version = self.log("event", keys), self.version(source)
        stale = cut_lineage(self.stale_events(source))
        outdated = log.snapshot().where((F.col("source") == source.name) & (F.col("version") != version))
        lost = cut_lineage(outdated.join(stale, keys, "left_anti").select(*keys))
        if stale.isEmpty() and lost.isEmpty():
            return stale.select(*keys, "reason", F.lit(0).cast("bigint").alias("n_rows"))
        # the join with few partitions prunes the folders of the raw table when it runs
        rows = self.raw(source).join(stale.select(*keys), keys, "left_semi")
        if source.match == "item":
            match = self.rules.frame(self.spark, "inline", ["item_id"])
        else:
            match = self.rules.steps(self.spark)
        event = events.build(rows, source, self.rules.lot_prefix, match, ["vehicle", "step_id"], ["arrival", *keys])
        touched = stale.select(*keys).unionByName(lost)
        built = cut_lineage(replace_partitions(event, self.path("event"), keys, touched, required=keys))
        entries = built.join(stale, keys, "left").withColumns({"version": F.lit(version), "removed": F.col("reason").isNull()})
        log.append(entries)
        self.report(f"keyless_{source.name.lower()}", events.keyless_dates(rows, "date"))
        return entries.where("NOT removed").select(*keys, "reason", "n_rows")

    def prune(self, today: str) -> dict[str, list[str]]:
        """Delete raw and event dates older than ``rules.keep_days``; what is gone leaves the log too."""
        if self.rules.keep_days <= 0:
            return {}
        out = {layer: partitions.delete_expired(self.spark, self.path(layer), self.rules.keep_days, today) for layer in ("raw", "event")}
        log = self.log("event", partitions.PARTITIONS)
        gone = partitions.expired(log.snapshot(), self.rules.keep_days, today)
        if not gone.isEmpty():
            log.append(cut_lineage(gone).withColumn("removed", F.lit(True)))
        return out

    def event(self, source: Source) -> DataFrame:
        return partitions.scan(self.spark, self.path("event"), source)

    def build_features(self) -> list[dict]:
        """The long feature table, replaced as a whole. Returns the rules that were skipped.

        Reports: skipped rules, overridden aggregates, recipes without a knob, and what the skip layer did,
        refused or held back.
        """
        registry, spark = self.rules.registry, self.spark
        fab, skipped, overrides = features.fab_rules(self.rules.fab, registry)
        mask, more = features.mask_rules(self.rules.mask, registry)
        skipped += more
        event = self.event(FAB)
        parts = []
        if fab:
            parts.append(features.as_long(features.text_features(event, fab, registry), "FAB"))
        if mask:
            parts.append(features.as_long(features.text_features(event, mask, registry), "MASK"))
        if self.rules.knob:
            parts.append(features.as_long(self.knob_features(event), "KNOB"))
            skipped += knob.aggregates_used(self.rules.knob, registry)[1]
        for name, source, value in (("inline", INLINE, "value"), ("vm", VM, "residual")):
            usable, more = features.number_rules(getattr(self.rules, name), source.name, registry)
            skipped += more
            if usable:
                item = "item_id" if source is INLINE else "sensor_id"
                made = features.number_features(self.event(source), usable, item, value, ["time"], registry)
                parts.append(features.as_long(made, source.name))
        if not parts:
            raise ValueError("no usable feature rule")
        long = parts[0]
        for part in parts[1:]:
            long = long.unionByName(part)
        replace_table(long, self.path("feature"), required=WAFER[:2], by=["category"], allow_empty=True)
        self.report("skipped_rules", self.spark.createDataFrame([(r["feature"], r["reason"]) for r in skipped], "feature string, reason string"))
        self.report("agg_overrides", self.spark.createDataFrame([(r["feature"], r["rule_agg"], r["applied"]) for r in overrides], "feature string, rule_agg string, applied string"))
        return skipped

    def knob_features(self, event: DataFrame) -> DataFrame:
        """Knob values, with SKIP for wafers that a rule or the passing order shows to have skipped."""
        rules = self.rules.knob_rules(self.spark)
        knob_map = knob.map_from_rules(rules, self.rules.steps(self.spark))
        aggs, _ = knob.aggregates_used(self.rules.knob, self.rules.registry)
        looked_up = knob.lookup(event, knob_map)
        values = knob.features(looked_up, self.rules.registry, aggs)
        self.report("knob_miss", knob.misses(looked_up))
        last = cut_lineage(skip.last_per_step(event))  # a row per wafer and step, read several times
        present = last.select("vehicle", "step_id").distinct()
        feature = F.concat(F.lit("KNOB_"), "step_desc", F.lit("_ppid")).alias("feature")
        steps = knob.mapped_steps(knob_map).select("vehicle", "step_id", feature)
        steps = cut_lineage(steps.join(present, ["vehicle", "step_id"], "left_semi"))
        conditions, targets = knob.block_conditions(rules), knob.block_targets(rules)
        known = present.select("vehicle", F.col("step_id").alias("name"))
        known = known.unionByName(self.rules.steps(self.spark).select("vehicle", F.col("step_desc").alias("name")))
        vehicles = sorted({r["vehicle"] for r in self.rules.step_map})
        blocks, aims, refused = skip.usable_blocks(conditions, targets, known, vehicles)
        missing = cut_lineage(skip.without_value(skip.candidates(last, steps), values))
        by_rule = skip.by_rule(last, missing, blocks, aims)
        by_blocks = skip.targeted(conditions, targets)
        auto, left = (df.join(by_blocks, "feature", "left_anti") for df in (steps, missing))
        found = cut_lineage(skip.anchors(skip.copassage(last, auto)))
        by_order = skip.by_order(last, left, found)
        kept = left.join(found, ["vehicle", "feature"], "left_anti").groupBy("vehicle", "feature").agg(F.count("*").alias("n_wafers"))
        reason = F.concat(F.lit("no later step known: "), F.col("n_wafers").cast("string"), F.lit(" wafers")).alias("reason")
        self.report("skip_refused", refused.unionByName(kept.select("vehicle", F.col("feature").alias("rule"), reason)))
        skips = by_rule.select(*WAFER, "feature", F.lit("rule").alias("mode"))
        skips = cut_lineage(skips.unionByName(by_order.select(*WAFER, "feature", F.lit("auto").alias("mode"))))
        self.report("knob_skip", skip.report(skips, skip.last_split(event)))
        skipped = skips.select(*WAFER, "feature", F.lit("SKIP").alias("value_str"))
        return values.select(*WAFER, "feature", "value_str").unionByName(skipped)

    def long(self) -> DataFrame:
        return features.with_values(self.spark.read.parquet(self.path("feature")))

    def build_wide(self) -> DataFrame:
        """The wide table of all vehicles, checked before it is written."""
        long = self.long()
        rows = long.where(features.has_value()).groupBy("feature").agg(F.max("category").alias("category"))
        kinds = {r["feature"]: r["category"] for r in rows.collect()}  # a name per rule
        numbers = sorted(f for f, c in kinds.items() if c in ("INLINE", "VM"))
        text = sorted(set(kinds) - set(numbers))
        products = rule_tables.table(self.spark, ["vehicle", "PRODUCT"], list(self.rules.products.items()))
        table = wide.pivot(long, text, numbers, products)
        keys = ["vehicle", *wide.WIDE_KEY]
        replace_table(table, self.path("wide"), required=keys, unique=keys)
        written = self.spark.read.parquet(self.path("wide"))
        log = self.log("wide", ["vehicle"])
        rows = written.groupBy("vehicle").agg(F.count("*").alias("n_rows")).withColumn("removed", F.lit(False))
        gone = log.snapshot().select("vehicle").join(rows, "vehicle", "left_anti")
        entries = cut_lineage(rows.unionByName(gone.withColumns({"n_rows": F.lit(0), "removed": F.lit(True)})))
        log.append(entries.withColumns({"written": F.current_timestamp(), "version": F.lit("")}))
        return written

    def publish(self) -> list[str]:
        """A folder per product. A product that the log knows and the wide table lacks loses its folder."""
        log = self.log("publish", ["product"])
        before = [r["product"] for r in log.snapshot().collect()]  # a configured list of products
        table = self.spark.read.parquet(self.path("wide"))
        now = wide.publish(table, self.path("published"), before)
        rows = [(p, False) for p in now] + [(p, True) for p in before if p not in now]
        entries = self.spark.createDataFrame(rows, "product string, removed boolean")
        sizes = wide.keep_last(table, wide.WIDE_KEY, ["vehicle"]).groupBy(wide.file_name("PRODUCT").alias("product")).agg(F.count("*").alias("n_rows"))
        entries = entries.join(sizes, "product", "left").fillna(0, ["n_rows"])
        log.append(entries.withColumns({"written": F.current_timestamp(), "version": F.lit("")}))
        return now

    def check_products(self) -> None:
        """The report ``product_checks``: days covered, the wide table, and whether its published copy is as new."""
        products = rule_tables.table(self.spark, ["vehicle", "PRODUCT"], list(self.rules.products.items()))
        products = products.select("vehicle", wide.file_name("PRODUCT").alias("product"))
        covered = self.event(FAB).groupBy("vehicle").agg(F.count_distinct("date").alias("days"))
        published = self.log("publish", ["product"]).snapshot().join(products, "product")
        self.report("product_checks", quality.product_checks(products, covered, self.log("wide", ["vehicle"]).snapshot(), published))

    def send(self) -> dict[str, str]:
        table = wide.keep_last(self.spark.read.parquet(self.path("wide")), wide.WIDE_KEY, ["vehicle"])
        return wide.write_send(table.drop("vehicle"), self.path("send"))

    def scan(self) -> str:
        """Reports on unmapped steps: what was found, what the exclusions took out, and hints on the rest."""
        by = ["vehicle", "step_id", "step_desc", "eqp_id", "eqp_model"]
        steps = self.rules.steps(self.spark)
        found = scan.unmatched(self.raw(FAB), steps, by)
        found = cut_lineage(found.withColumn("excluded_by", scan.exclusion_reason(self.rules.exclude_eqp, self.rules.exclude_model)))
        shown = found.where("excluded_by IS NULL").drop("excluded_by")
        self.report("unmatched", shown)
        self.report("unmatched_excluded", found.where("excluded_by IS NOT NULL"))
        settings = scan.hint_settings(self.rules.hints)
        recent = scan.recent_rows(self.raw(FAB), "date", settings["days"])
        columns = [c for c in self.rules.hint_columns if c in recent.columns]
        wanted = shown.select("vehicle", "step_id").distinct()
        self.report("step_hints", scan.hints(recent, wanted, steps, columns, ["tkout_time", "arrival"], settings))
        return self.path("reports/unmatched")

    def all_stages(self, today: str | None = None, raw_errors: list[str] | None = None) -> dict:
        """Every stage, and what each did.

        ``raw_errors`` are extraction units that failed: events, features and scans still run, but a wide
        table of partial input does not replace the former one, nor is it published or sent. Without any
        event rows the features and all that follow stay as they are.
        """
        out: dict = {"pruned": self.prune(today) if today else {}, "event": {}}
        for source in SOURCES.values():
            has_rules = source.match == "step" or self.rules.inline
            if source.has_event and has_rules:
                built = self.refresh_events(source).agg(F.count("*").alias("dates"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows")).first()
                out["event"][source.name] = built.asDict()
        if self.log("event", partitions.PARTITIONS).snapshot().where("n_rows > 0").isEmpty():
            out["feature"] = out["wide"] = {"not run": "no event rows"}
        else:
            out["feature"] = {"skipped": self.build_features()}
            if raw_errors:
                out["wide"] = {"not run": "raw extraction failed", "raw_errors": len(raw_errors)}
            else:
                self.build_wide()
                out["wide"] = {"published": self.publish(), "sent": self.send()}
            if self.rules.products:
                self.check_products()
        if not self.raw(FAB).isEmpty():
            self.scan()
        return out
