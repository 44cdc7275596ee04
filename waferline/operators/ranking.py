"""Positions, ranks and exact order statistics that split hot groups over tasks."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.session import cut_lineage

# Steps of the histogram that brackets a rank, and the accuracy of its sketch: an error well below a step.
STEPS = 1_000
ACCURACY = 20_000


def running_total(df: DataFrame, keys: list[str], order: list[str], weight: Column, out: str) -> DataFrame:
    """Running sum of ``weight`` within a group, the row itself included, and the group's ``total``.

    Rows are range-partitioned by group and order. Each task sums its own stretch, and a small
    table (one row per group and task) carries the offsets of earlier stretches. The stretches
    are materialised once, since the sampled range bounds must be the same for both uses.
    ``order`` must be unique within a group.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = [F.col(c).asc_nulls_first() for c in keys + order]
    rows = df.withColumn("_w", weight.cast("bigint")).repartitionByRange(tasks, *bounds)
    rows = cut_lineage(rows.withColumn("_part", F.spark_partition_id()))
    sums = rows.groupBy(*keys, "_part").agg(F.sum("_w").alias("_part_w"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_part_w").over(before), F.lit(0)).alias("_offset"),
        F.sum("_part_w").over(group).alias("total"),
    )
    within = Window.partitionBy(*keys, "_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", F.sum("_w").over(within)).alias("l")
    sums = sums.alias("r")
    on = F.col("l._part") == F.col("r._part")
    for key in keys:  # null group values match themselves
        on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    position = (F.col("l._local") + F.col("r._offset")).alias(out)
    return local.join(sums, on).select(*[F.col(f"l.{c}") for c in df.columns], position, "r.total")


def dense_positions(df: DataFrame, keys: list[str], order: str, out: str) -> DataFrame:
    """Distinct (group, order) pairs with their dense rank."""
    pairs = df.select(*keys, order).distinct()
    return running_total(pairs, keys, [order], F.lit(1), out).drop("total")


def _sorted_value_at(rows: DataFrame, keys: list[str], positions: dict[str, Column]) -> DataFrame:
    """Values at positions by sorting the distinct values of ``_value`` over ranges."""
    counts = rows.groupBy(*keys, "_value").agg(F.count("*").alias("_n"))
    runs = running_total(counts, keys, ["_value"], F.col("_n"), "_upto")

    def at(position: Column) -> Column:
        inside = (F.col("_upto") >= position) & (F.col("_upto") - F.col("_n") < position)
        return F.max(F.when(inside, F.col("_value")))

    return runs.groupBy(*keys).agg(*[at(p).alias(name) for name, p in positions.items()])


def _brackets(rows: DataFrame, keys: list[str], positions: dict[str, Column]) -> DataFrame:
    """Per group, ``_ranks``: for each position the steps of an equi-depth histogram around it; null is open.

    The histogram is a quantile sketch, which combines on the map side and is of bounded size.
    """
    steps = [i / STEPS for i in range(STEPS + 1)]
    found = rows.groupBy(*keys).agg(F.count("*").alias("total"), F.percentile_approx("_value", steps, ACCURACY).alias("_steps"))

    def bracket(name: str, position: Column) -> Column:
        step = position / F.col("total") * STEPS
        low, high = F.floor(step).cast("int") - 1, F.ceil(step).cast("int") + 1
        return F.struct(
            F.lit(name).alias("name"), position.cast("bigint").alias("position"),
            F.when(low > 0, F.get("_steps", low)).alias("low"), F.when(high < STEPS, F.get("_steps", high)).alias("high"),
        )

    return found.select(*keys, F.array(*[bracket(name, p) for name, p in positions.items()]).alias("_ranks"))


def _same_group(left: str, right: str, keys: list[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def value_at(df: DataFrame, keys: list[str], value: str, positions: dict[str, Column]) -> DataFrame:
    """Per group, the values at the given 1-based positions of the sorted non-null values.

    A position may use the column ``total``, the group's number of values. Numbers and times are found by
    a histogram: it brackets each position, then one pass counts what lies below the bracket and the distinct
    values in it, about two steps of ``STEPS``. Only these counts are shuffled and sorted. The counts prove the
    result; a group whose position is not within its bracket is sorted whole, as are values of other types.
    """
    rows = df.select(*keys, F.col(value).alias("_value")).where("_value IS NOT NULL")
    if not isinstance(rows.schema["_value"].dataType, (T.NumericType, T.TimestampType, T.DateType)):
        return _sorted_value_at(rows, keys, positions)
    if not keys:
        return value_at(rows.withColumn("_all", F.lit(0)), ["_all"], "_value", positions).drop("_all")
    ranked = rows.alias("l").join(_brackets(rows, keys, positions).alias("r"), _same_group("l", "r", keys))
    ranked = ranked.select(*[F.col(f"l.{k}") for k in keys], "_value", F.explode("_ranks").alias("_rank"))
    # below the bracket only the number counts; above it nothing does
    ranked = ranked.where(~F.coalesce(F.col("_value") > F.col("_rank.high"), F.lit(False)))
    within = ~F.coalesce(F.col("_value") < F.col("_rank.low"), F.lit(False))
    ranked = ranked.select(
        *keys, F.col("_rank.name").alias("_name"), F.col("_rank.position").alias("_position"),
        within.alias("_within"), F.when(within, F.col("_value")).alias("_value"),
    )
    counts = ranked.groupBy(*keys, "_name", "_position", "_within", "_value").agg(F.count("*").alias("_n"))
    runs = running_total(counts, [*keys, "_name"], ["_within", "_value"], F.col("_n"), "_upto")
    hit = F.col("_within") & (F.col("_upto") >= F.col("_position")) & (F.col("_upto") - F.col("_n") < F.col("_position"))
    found = runs.groupBy(*keys).agg(*[F.max(F.when(hit & (F.col("_name") == name), F.col("_value"))).alias(name) for name in positions])
    found = cut_lineage(found)
    missed = reduce(or_, [F.col(name).isNull() for name in positions])
    again = found.where(missed).select(*keys)
    if again.isEmpty():
        return found
    rest = rows.alias("l").join(again.alias("r"), _same_group("l", "r", keys), "left_semi")
    return found.where(~missed).unionByName(_sorted_value_at(rest, keys, positions))


def nearest_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles: the value at position round(p * (n - 1)), halves to even."""
    last = F.col("total") - 1
    positions = {name: F.bround(F.lit(p) * last, 0).cast("bigint") + 1 for name, p in ranks.items()}
    return value_at(df, keys, value, positions)


def exact_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Exact median per group, the mean of the two middle values for an even count."""
    middle = {"low": F.expr("(total + 1) div 2"), "high": F.expr("total div 2 + 1")}
    found = value_at(df, keys, value, middle)
    return found.select(*keys, ((F.col("low") + F.col("high")) / 2).alias(out))


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, with their position as ``rank``.

    Spark cuts each group to ``n`` rows before the shuffle when a row number is filtered directly.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint"))


def by_hash(df: DataFrame, keys: list[str]) -> GroupedData:
    """``df`` grouped by ``keys`` (texts and whole numbers), their hash in front as ``_hash``.

    Aggregates that hold texts are sorted by their group. The hash leads the sort, so that rows are told apart by one
    number and not by texts that begin alike. Groups are the same.
    """
    return df.withColumn("_hash", F.xxhash64(*keys)).groupBy("_hash", *keys)


def first_texts(df: DataFrame, keys: list[str], value: str, n: int, out: str, sep: str = ",") -> DataFrame:
    """The first ``n`` distinct values of each group in sorted order, as one text."""
    pairs = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    kept = top_rows(pairs, keys, [F.col(value)], n)
    return kept.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(out))
