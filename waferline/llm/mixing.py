"""Mixing sources to target weights by entropy balancing.

Each source has a target of words. Document rates start at 1 and are tilted exponentially by the document's
size, ``rate = min(MOST, exp(dual * size / mean size))``, with one dual variable per source: the rates with
the least relative entropy to 1 whose words meet the targets. Newton steps on the convex dual, each one
aggregate over a table of sizes, find the duals. Rates are then rounded into whole copies: those of the
largest documents first, then the others are solved again for what these leave of the target.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.session import cut_lineage

#: A document is taken so many times at most, and a source's target is at most so many times its size.
MOST = 3
#: Documents per source that even out what rounding leaves, half of them its largest; all of a source with fewer.
EVENING_DOCS = 256
TOLERANCE = 1e-9
MOST_ROUNDS = 60
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A text that is never null: the source after a letter, or the letter for null, which sorts last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("z"))


@dataclass
class Mix:
    """``sources``: skey, source_size, target, mean, dual. ``even``: copies of the documents that even out.

    Mean and dual are those of the documents that are not among the largest.
    """

    sources: DataFrame
    even: DataFrame


def targets(sources: DataFrame) -> DataFrame:
    """skey, source_size, n, target from skey, source_size, n.

    Sources in order of their key weigh 1, 2, 3 and so on in turn, and share all words by weight. A target
    stops at ``MOST`` times its source's size, and the excess is shared by the others the same way until
    none is above. That level, words per weight, follows from the sources in order of size per weight: so
    many of the first are full that the rest, at what is left per weight, are not. One row per source.
    """
    place = F.row_number().over(Window.orderBy("skey"))
    weighed = sources.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))
    room = (MOST * F.col("source_size")).cast("double")
    order = Window.orderBy("full_at", "skey")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    levels = weighed.withColumn("full_at", room / F.col("weight"))
    levels = levels.withColumn("level", (total - F.coalesce(F.sum(room).over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # the level of the first source that is not full holds for it and all later ones
    open_ = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "skey", "level"))
    first = F.min(open_).over(Window.partitionBy())
    levels = levels.withColumn("first", first)
    full = F.col("first").isNull() | (F.struct("full_at", "skey") < F.struct(F.col("first.full_at"), F.col("first.skey")))
    target = F.when(full, room).otherwise(F.least(room, F.col("first.level") * F.col("weight")))
    return levels.select("skey", "source_size", "n", target.alias("target"))


def rate(dual: Column, size: Column, mean: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(dual * size / mean, F.lit(700.0))))


def solve_duals(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with mean and dual, from (skey, size, n): how many documents of a source have a size.

    Newton steps on each source's dual, with halving where a step leaves the bracket of the root. A full
    source needs no root; nor does an empty one. A round is one aggregate, and its row per source is written
    to the shared folder, so lineage doesn't grow.
    """
    mean = F.greatest(F.col("source_size") / F.greatest(F.col("n"), F.lit(1)), F.lit(1e-9))
    # in units of words a full or empty source has nothing to solve
    needs = (F.col("source_size") > 0) & (F.col("target") < MOST * F.col("source_size") * (1 - 1e-12)) & (F.col("target") > 0)
    none = F.lit(None).cast("double")
    start = F.when(needs, F.log(F.col("target") / F.col("source_size"))).otherwise(F.when(F.col("target") > 0, F.lit(1e9)).otherwise(F.lit(-1e9)))
    state = sources.withColumn("mean", mean).withColumn("open", needs)
    state = cut_lineage(state.withColumn("dual", start).withColumn("low", none).withColumn("high", none))
    for _ in range(MOST_ROUNDS):
        if state.where("open").isEmpty():
            break
        z = F.col("size") / F.col("mean")
        words = (F.col("n_docs") * F.col("size")).cast("double")
        grown = F.exp(F.least(F.col("dual") * z, F.lit(700.0)))
        rows = sizes.withColumnRenamed("n", "n_docs").join(state.where("open").select("skey", "mean", "dual"), "skey")
        sums = rows.groupBy("skey").agg(F.sum(words * F.least(grown, F.lit(float(MOST)))).alias("got"), F.sum(F.when(grown < MOST, words * z * grown).otherwise(0.0)).alias("slope"))
        now = state.join(sums, "skey", "left").withColumn("off", F.col("got") - F.col("target"))
        now = now.withColumn("low", F.when(F.col("off") < 0, F.col("dual")).otherwise(F.col("low"))).withColumn("high", F.when(F.col("off") >= 0, F.col("dual")).otherwise(F.col("high")))
        newton = F.when(F.col("slope") > 0, F.col("dual") - F.col("off") / F.col("slope"))
        inside = newton.isNotNull() & (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        stride = F.greatest(F.abs("dual"), F.lit(1.0))
        step = F.when(inside, newton).when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2).when(F.col("off") < 0, F.col("dual") + stride).otherwise(F.col("dual") - stride)
        done = F.abs("off") <= TOLERANCE * F.col("target")
        moved = F.when(F.col("open") & ~done, step).otherwise(F.col("dual"))
        still = F.col("open") & ~done
        state = cut_lineage(now.withColumn("dual2", moved).withColumn("open2", still).select("skey", "source_size", "n", "target", "mean", F.col("open2").alias("open"), F.col("dual2").alias("dual"), "low", "high"))
    return state.select("skey", "source_size", "target", "mean", "dual")


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) that is the same for the same values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def solve(rows: DataFrame) -> Mix:
    """The mix for rows of doc_id, skey, size.

    The ``EVENING_DOCS // 2`` largest units of a source (rows that repeat a document are one) are rounded
    first, from the largest on: each takes the copies that come nearest to what is still wanted. No draw makes
    up for such a one, so the rates of all others are solved again for the words that these leave. Those are
    rounded up with the odds of the rate's fraction, by a hash of the document, so reruns agree. As many more of
    them, picked by the same kind of hash, are left for last and even out the rest like the largest. In a source
    of no more than ``EVENING_DOCS`` documents all are such, so that its words miss the target by half its
    smallest documents.
    """
    units = cut_lineage(rows.groupBy("skey", "doc_id", "size").agg(F.count("*").alias("times")))
    sizes = cut_lineage(units.groupBy("skey", "size").agg(F.sum("times").alias("n")))
    sources = targets(sizes.groupBy("skey").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n")))
    solved = solve_duals(sizes, sources)
    words = F.col("times") * F.col("size")
    hashed = F.xxhash64(F.lit("even"), "doc_id", "size")
    most = Window.partitionBy("skey").orderBy(words.desc(), hashed, "doc_id", "size")
    large = cut_lineage(_first(units, most, EVENING_DOCS // 2))
    done = cut_lineage(_round(_rated(large, solved), solved.select("skey", F.lit(0.0).alias("want"))))
    # what is left for the others: sources, targets and sizes without the largest
    given = done.join(large, _same(done, large)).groupBy("e_skey").agg(F.sum(words * F.col("even_copies")).alias("given"), F.sum(words).alias("large_size"), F.sum("times").alias("large_n"))
    given = given.withColumnRenamed("e_skey", "skey")
    none = lambda c: F.coalesce(c, F.lit(0))
    left = sources.join(given, "skey", "left").select("skey", (F.col("source_size") - none("large_size")).alias("source_size"), (F.col("n") - none("large_n")).alias("n"), F.greatest(F.col("target") - none("given"), F.lit(0.0)).alias("target"))
    lost = large.groupBy("skey", "size").agg(F.sum("times").alias("gone"))
    fewer = sizes.join(lost, ["skey", "size"], "left").select("skey", "size", (F.col("n") - none("gone")).alias("n")).where("n > 0")
    again = solve_duals(fewer, cut_lineage(left))
    rest = units.join(done, _same(done, units), "left_anti")
    chosen = cut_lineage(_first(rest, Window.partitionBy("skey").orderBy(hashed, "doc_id", "size"), EVENING_DOCS - EVENING_DOCS // 2))
    all_taken = _rated(rest, again).groupBy("skey").agg(F.sum(words * _copies()).alias("taken"))
    picked = _rated(chosen, again).groupBy("skey").agg(F.sum(words * _copies()).alias("drawn"), F.sum(words * F.col("rate")).alias("planned"))
    want = again.join(all_taken, "skey").join(picked, "skey").select("skey", (F.col("target") - (F.col("taken") - F.col("drawn")) - F.col("planned")).alias("want"))
    even = done.unionByName(_round(_rated(chosen, again), want))
    final = solved.select("skey", "source_size", "target").join(again.select("skey", "mean", "dual"), "skey")
    return Mix(cut_lineage(final), cut_lineage(even))


def _first(units: DataFrame, order: Window, count: int) -> DataFrame:
    """Of each source the first ``count`` units with words."""
    return units.where("size > 0").withColumn("place", F.row_number().over(order)).where(F.col("place") <= count).drop("place")


def _rated(units: DataFrame, solved: DataFrame) -> DataFrame:
    return units.join(solved.select("skey", "mean", "dual"), "skey").withColumn("rate", rate(F.col("dual"), F.col("size"), F.col("mean")))


def _round(units: DataFrame, want: DataFrame) -> DataFrame:
    """e_skey, e_doc, e_size, even_copies: from the largest on, the copies that come nearest to what is planned and wanted."""
    each = F.struct((F.col("times") * F.col("size")).alias("words"), "doc_id", "size", "rate")
    lists = units.groupBy("skey").agg(F.sort_array(F.collect_list(each), asc=False).alias("docs")).join(want, "skey")
    kind = "struct<want:double,done:array<struct<e_doc:bigint,e_size:bigint,even_copies:bigint>>>"
    start = F.struct(F.col("want").alias("want"), F.array().cast("array<struct<e_doc:bigint,e_size:bigint,even_copies:bigint>>").alias("done")).cast(kind)

    def take(a: Column, d: Column) -> Column:
        due = a["want"] + d["words"] * d["rate"]
        copies = F.least(F.greatest(F.round(due / d["words"]), F.lit(0.0)), F.lit(float(MOST))).cast("bigint")
        done = F.concat(a["done"], F.array(F.struct(d["doc_id"].alias("e_doc"), d["size"].alias("e_size"), copies.alias("even_copies"))))
        return F.struct((due - copies * d["words"]).alias("want"), done.alias("done")).cast(kind)

    return lists.select(F.col("skey").alias("e_skey"), F.inline(F.aggregate("docs", start, take)["done"]))


def _same(even: DataFrame, rows: DataFrame) -> Column:
    return (rows["skey"] == even["e_skey"]) & rows["doc_id"].eqNullSafe(even["e_doc"]) & (rows["size"] == even["e_size"])


def _copies() -> Column:
    """Copies by the odds of the rate's fraction."""
    return F.least(F.floor(F.col("rate") + _draw(F.lit("draw"), F.col("skey"), F.col("doc_id"), F.col("size"))), F.lit(MOST)).cast("bigint")


def add_copies(rows: DataFrame, mix: Mix) -> DataFrame:
    """Rows with doc_id, skey, size and any other columns, and source_size, target, copies.

    The table of sources and that of the documents that even out hold a row, and at most ``EVENING_DOCS``
    rows, per source.
    """
    out = rows.join(mix.sources, "skey").withColumn("rate", rate(F.col("dual"), F.col("size"), F.col("mean")))
    out = out.join(mix.even, _same(mix.even, out), "left")
    return out.withColumn("copies", F.coalesce("even_copies", _copies())).drop("mean", "dual", "rate", "e_skey", "e_doc", "e_size", "even_copies")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, skey, size of every row."""
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), source_key(docs["source"]).alias("skey"), size_of(docs["text"]).alias("size"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every row.

    Size is the number of words, 0 for null, empty and blank texts, which are taken once and bring nothing.
    Rows that repeat doc_id, source and size get the same copies each. Null sources are one source, the
    last; null ids are ids like others. An empty table gives no rows.
    """
    rows = cut_lineage(measured(docs))
    out = add_copies(rows, solve(rows))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
