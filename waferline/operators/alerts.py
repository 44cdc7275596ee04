"""Stage health, stall alerts, and the life of an alert list."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.text import is_blank
from waferline.sources.partitions import row_digest

# The stages that hold dates, the stage each stage follows, statuses that hide an alert, severity order.
DATED = ("raw", "event", "feature")
UPSTREAM = {"event": "raw", "feature": "event", "wide": "feature", "publish": "wide", "send": "wide"}
HIDDEN = ("미확인예정", "반영불필요")
SEVERITY_RANK = {"info": 0, "warn": 1, "warning": 1, "error": 2, "critical": 3}


def stage_health(stages: DataFrame, today: str, now: Column, threshold_days: int, age_stages: list[str]) -> DataFrame:
    """Lag, distance behind the stage before, and whether a stage is stalled by itself.

    ``stages`` has vehicle, source, stage, latest_date and built (a timestamp). Stages up to the features hold
    dates and are compared by them: a stage without one is missing. Later ones hold no dates; they are compared by when
    they were built, with the newest build of the stage before in the same vehicle, and are missing if they
    never were. ``age_stages`` are judged by age too. A stage that is only as late as the one before it
    is a cascade, not a cause.
    """
    dated = F.col("stage").isin(*DATED)
    upstream = F.create_map(*[F.lit(x) for pair in UPSTREAM.items() for x in pair])
    rows = stages.withColumn("upstream", F.try_element_at(upstream, F.col("stage")))
    # by dates of the same source where both sides have them, else by builds of the vehicle
    by_source = stages.where(dated).select("vehicle", "source", F.col("stage").alias("upstream"), F.col("latest_date").alias("ahead_date"))
    by_vehicle = stages.groupBy("vehicle", F.col("stage").alias("upstream")).agg(F.max("built").alias("ahead_built"))
    rows = rows.join(by_source, ["vehicle", "source", "upstream"], "left").join(by_vehicle, ["vehicle", "upstream"], "left")
    latest, ahead = F.col("latest_date").cast("date"), F.col("ahead_date").cast("date")
    seconds = F.unix_seconds(F.col("ahead_built").cast("timestamp")) - F.unix_seconds(F.col("built").cast("timestamp"))
    late = F.when(dated, F.datediff(ahead, latest)).otherwise(F.floor(seconds / 86_400))
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("built").cast("timestamp"))
    known = F.when(dated, latest.isNotNull() & ahead.isNotNull()).otherwise(F.col("upstream").isNotNull())
    rows = rows.select(
        "vehicle", "source", "stage", "latest_date",
        F.floor(age / 3600).alias("age_hours"),
        F.datediff(F.lit(today).cast("date"), latest).cast("bigint").alias("lag_days"),
        F.when(known, F.col("upstream")).alias("behind_of"),
        F.when(known, F.greatest(late, F.lit(0)).cast("bigint")).alias("behind_days"),
        F.when(dated, F.col("latest_date").isNull()).otherwise(F.col("built").isNull()).alias("missing"),
    )
    rows = rows.withColumn("behind_days", F.when(F.col("missing"), None).otherwise(F.col("behind_days")))
    return _judge(rows, threshold_days, age_stages)


def _judge(rows: DataFrame, threshold: int, age_stages: list[str]) -> DataFrame:
    gone = F.when(F.col("missing"), F.lit("missing"))
    lag = F.when(F.col("lag_days") > threshold, F.concat(F.lit("lag "), F.col("lag_days").cast("string")))
    behind = F.when(
        F.col("behind_days") > threshold,
        F.concat(F.lit("behind "), F.col("behind_of"), F.lit(" "), F.col("behind_days").cast("string")),
    )
    old = F.col("stage").isin(age_stages) & (F.col("age_hours") > threshold * 24)
    age = F.when(old, F.lit("old"))
    reason = F.coalesce(gone, F.concat_ws("; ", lag, behind, age))
    rows = rows.withColumn("reason", reason).withColumn("stalled", F.col("reason") != "")
    own = F.col("missing") | behind.isNotNull() | F.col("behind_of").isNull()
    return rows.withColumn("cascade", F.col("stalled") & ~own)


def stall_alerts(health: DataFrame, global_stages: list[str]) -> DataFrame:
    """Alerts of the causes only. Stages over all vehicles have one id for all of them."""
    scope = F.when(F.col("stage").isin(global_stages), F.lit("-")).otherwise(F.col("vehicle"))
    return health.where(F.col("stalled") & ~F.col("cascade")).select(
        F.concat_ws("|", F.lit("stall"), scope, "stage", "source").alias("id"),
        F.lit("stage_stall").alias("type"), "vehicle", "stage", "source", "reason",
    )


def roll_up(combos: DataFrame, keys: list[str]) -> DataFrame:
    """One alert per step: rows summed, lots at most, equipment as sorted distinct text."""
    sums = combos.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.max("n_lots").alias("n_lots"))
    for name in ("eqp_id", "eqp_model"):
        values = combos.where(~is_blank(name)).select(*keys, name).distinct()
        text = values.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(name)), ", ").alias(name))
        sums = sums.join(text, keys, "left").withColumn(name, F.coalesce(name, F.lit("")))
    return sums


def roll_up_misses(misses: DataFrame) -> DataFrame:
    """One alert per step and recipe: lots and wafers summed over splits, the splits as sorted text."""
    keys = ["vehicle", "step_id", "ppid"]
    sums = misses.groupBy(*keys).agg(
        F.min("step_desc").alias("step_desc"), F.sum("n_lots").alias("n_lots"), F.sum("n_wafers").alias("n_rows")
    )
    splits = misses.select(*keys, "split").where("split IS NOT NULL").distinct()
    text = splits.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("split")), ", ").alias("split"))
    id_text = F.concat_ws("|", F.lit("ro"), *keys).alias("id")
    return sums.join(text, keys, "left").select(id_text, *keys, "step_desc", F.coalesce("split", F.lit("")).alias("split"), "n_lots", "n_rows")


def with_status(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Alerts without repeats of an id (the first vehicle's row counts), with their status."""
    rest = [c for c in alerts.columns if c not in ("id", "vehicle")]
    first = F.min(F.struct("vehicle", *rest)).alias("row")
    unique = alerts.groupBy("id").agg(first).select("id", "row.*")
    joined = unique.join(acks.select("id", "status", "note"), "id", "left")
    return joined.withColumn("status", F.coalesce("status", F.lit("active"))).withColumn(
        "note", F.coalesce("note", F.lit(""))
    )


def active_first() -> list[Column]:
    return [(F.col("status") != "active").cast("int"), F.col("type"), F.col("vehicle"), F.col("id")]


def delta(now: DataFrame, before: DataFrame) -> DataFrame:
    """Ids that became active and ids that stopped being active between two snapshots."""
    shown = ~F.col("status").isin(*HIDDEN)
    new = now.where(shown).select("id", F.lit(1).alias("in_now"))
    old = before.where(shown).select("id", F.lit(1).alias("in_before"))
    both = new.join(old, "id", "full_outer")
    change = F.when(F.col("in_before").isNull(), "new").when(F.col("in_now").isNull(), "resolved")
    return both.select("id", change.alias("change")).where("change is not null")


def first_seen(now: DataFrame, before: DataFrame, clock: Column) -> DataFrame:
    """Alerts inherit the time they were first seen from the snapshot before."""
    old = before.select("id", F.col("first_seen").alias("inherited"))
    return now.join(old, "id", "left").withColumn("first_seen", F.coalesce("inherited", clock)).drop("inherited")


def alert_fingerprint(alerts: DataFrame) -> DataFrame:
    """Per vehicle, one number that changes with its alert ids, statuses and stall reasons.

    An order-free sum, so that no vehicle's alerts meet in one task.
    """
    reason = F.when(F.col("type") == "stage_stall", F.col("reason")).otherwise("")
    rows = alerts.select("vehicle", "id", "status", reason.alias("why"))
    total = F.sum(row_digest(["id", "status", "why"]).cast("decimal(20,0)")).cast("string")
    return rows.groupBy("vehicle").agg(F.count("*").alias("n"), total.alias("fingerprint"))


def timeline_pieces(rows: DataFrame, scope: str, pause: int) -> DataFrame:
    """(scope, slot, piece): the slots of ``pause`` seconds that a scope has rows in, cut where slots are empty.

    Between two pieces lies at least one whole empty slot, so nothing that lasts up to ``pause`` seconds goes
    from one to the next. A scope has a row a slot here, whatever its number of rows.
    """
    slots = rows.select(scope, F.floor(F.col("second") / pause).alias("slot")).distinct()
    in_order = Window.partitionBy(scope).orderBy("slot")
    begins = F.coalesce(F.col("slot") - F.lag("slot").over(in_order) > 1, F.lit(False)).cast("int")
    marked = slots.withColumn("begins", begins)
    return marked.withColumn("piece", F.sum("begins").over(in_order)).drop("begins")


def gate(alerts: DataFrame, scope: str, min_severity: str, max_per_hour: int, window_sec: int) -> DataFrame:
    """Which alerts go out: severity floor, hourly cap, no repeat of a kind within the window.

    ``alerts`` has the scope column, alert_id, kind, severity and second (whole epoch seconds). Outcomes are
    severity, rate_limit, dedupe and sent, tested in this order; a cap or window of 0 is none. Alerts are
    walked by second, then by id. What was sent counts for an hour at most, and a kind for the window, so a
    scope's time is cut wherever it pauses that long, and its pieces go to different tasks. A task holds the
    times of the last hour (as many as the cap at most) and a time for each kind of its window.
    """
    if window_sec < 0:
        raise ValueError("the window can't be negative")
    rank = F.lit(0)
    for name, level in SEVERITY_RANK.items():
        rank = F.when(F.lower("severity") == name, level).otherwise(rank)
    loud = F.coalesce(rank >= SEVERITY_RANK[min_severity], F.lit(False))
    marked = alerts.withColumn("loud", loud)
    heard = marked.where("loud").drop("loud")
    pause = max(3600, window_sec)
    heard = heard.withColumn("slot", F.floor(F.col("second") / pause))
    heard = heard.join(timeline_pieces(heard, scope, pause), [scope, "slot"])
    dealt = heard.repartition(scope, "piece").sortWithinPartitions(scope, "piece", "second", "alert_id")

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, recent, emitted, oldest = None, deque(), {}, 0
        for batch in batches:
            outcome = []
            for key, piece, second, kind in zip(batch[scope], batch["piece"], batch["second"], batch["kind"]):
                if (key, piece) != current:
                    current, recent, emitted, oldest = (key, piece), deque(), {}, second
                while recent and second - recent[0] >= 3600:
                    recent.popleft()
                if second - oldest >= pause:  # forget kinds whose window is over
                    emitted, oldest = {k: t for k, t in emitted.items() if second - t < window_sec}, second
                if max_per_hour > 0 and len(recent) >= max_per_hour:
                    outcome.append("rate_limit")
                elif second - emitted.get(kind, second - window_sec) < window_sec:
                    outcome.append("dedupe")
                else:
                    if window_sec:
                        emitted[kind] = second
                    if max_per_hour > 0:
                        recent.append(second)
                    outcome.append("sent")
            yield batch.drop(columns=["piece", "slot"]).assign(outcome=outcome)

    schema = T.StructType([*heard.drop("piece", "slot").schema.fields, T.StructField("outcome", T.StringType())])
    columns = [*heard.drop("piece", "slot").columns, "piece", "slot"]
    decided = dealt.select(*columns).mapInPandas(decide, schema)
    quiet = marked.where("NOT loud").select(*alerts.columns, F.lit("severity").alias("outcome"))
    return decided.select(*alerts.columns, "outcome").unionByName(quiet)
