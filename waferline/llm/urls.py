"""URL filtering by fixed rules, and by association rules of URL tokens where no fixed rule fits.

FP-growth mines combinations of tokens that stand with one verdict in labelled URLs. A rule is kept if its
support and confidence suffice and no rule with fewer of its tokens is as confident. An inverted index from
tokens to rules finds the rules that a URL holds whole. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.session import cut_lineage

#: Least share of the labelled URLs that a combination stands in, and least share of it with one verdict.
SUPPORT = 0.01
CONFIDENCE = 0.8
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds ``rule`` (host and path) and ``rule_verdict`` of the longest rule that fits ``host`` and ``path``, or nulls.

    ``rules`` are (verdict, host, path). A rule fits its host and all subdomains if the path begins with its
    path. Longest is by length of host and path together; of equal ones the first in the list.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(enumerate(rules), key=lambda r: (-len(r[1][1] + r[1][2]), r[0]))
    for _, (what, host, path) in reversed(ranked):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return pages.withColumn("rule", name).withColumn("rule_verdict", verdict)


def tokens() -> Column:
    """Distinct tokens of ``host`` and ``path``: top domain, domain, every label below it, every path part with
    its neighbour, file ending. Empty ones are left out; the first part's neighbour is the root.

    Their number grows with the URL. Which of them are worth mining is decided by their support, not by place.
    """
    labels = F.split("host", r"\.")
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)
    below = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    rooted = F.concat(F.array(F.lit("")), parts)
    pairs = F.zip_with(F.slice(rooted, F.lit(1), F.size(parts)), parts, lambda a, b: F.concat(F.lit("pair="), a, F.lit("/"), b))
    found = F.concat(
        F.array(
            F.concat(F.lit("top="), F.element_at(labels, -1)),
            F.concat(F.lit("domain="), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")),
            F.concat(F.lit("ending="), F.when(ending != "", ending)),
        ),
        F.transform(below, lambda l: F.concat(F.lit("label="), l)),
        F.transform(parts, lambda p: F.concat(F.lit("part="), p)),
        pairs,
    )
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(found)))


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _frequent(marked: DataFrame, support: float) -> DataFrame:
    """(name, members): tokens with the support, those that stand in the very same rows as one, under its shortest.

    Any member may stand for the others in a combination without a change of its counts, so nothing is lost.
    The rows of a token are told by their number and the sum of their hashes.
    """
    least = math.ceil(support * marked.count())
    row = F.xxhash64("items").cast("decimal(20,0)").alias("row")
    counts = marked.select(row, F.explode(F.array_distinct("items")).alias("item")).groupBy("item").agg(F.count("*").alias("n"), F.sum("row").alias("rows"))
    return counts.where(F.col("n") >= least).groupBy("n", "rows").agg(
        F.min(F.struct(F.length("item"), "item"))["item"].alias("name"), F.array_sort(F.collect_list("item")).alias("members")
    ).select("name", "members")


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(rule_id, items, members, verdict, confidence, support, size) from rows with ``items`` and ``verdict``.

    Rows with a null verdict are left out. ``members`` has, for each of ``items``, the tokens that stand in the
    same labelled rows: a rule holds with any one of each. Tokens below the support are dropped before FP-growth,
    which would drop them too; what is left is at most (tokens a row) / ``support``, whatever the table's size.
    A row adds up to 2**k combinations of its k frequent names. Without rows there are no rules.
    """
    marked = cut_lineage(labelled.where("verdict IS NOT NULL").select("items", "verdict"))
    empty = "rule_id int, items array<string>, members array<array<string>>, verdict string, confidence double, support double, size int"
    if marked.isEmpty():
        return labelled.sparkSession.createDataFrame([], empty)
    classes = cut_lineage(_frequent(marked, support))
    names = _literals([r["name"] for r in classes.select("name").orderBy("name").collect()])
    baskets = cut_lineage(marked.select(F.concat(F.array_intersect("items", names), F.array(F.concat(F.lit("verdict="), F.col("verdict")))).alias("items")))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets).associationRules
    rules = found.select(F.array_sort("antecedent").alias("items"), F.get("consequent", F.lit(0)).alias("verdict"), "confidence", "support")
    rules = rules.where(F.startswith("verdict", F.lit("verdict="))).withColumn("verdict", F.substring("verdict", 9, 100))
    rules = cut_lineage(rules.withColumn("size", F.size("items")).withColumn("key", F.array_join("items", "\n")))
    # a rule falls if one with some of its tokens has the same verdict and no less confidence
    part = rules.select(F.col("key").alias("short"), "verdict", F.col("size").alias("short_size"), F.col("confidence").alias("short_confidence"), F.explode("items").alias("item"))
    whole = rules.select("key", "verdict", "size", "confidence", F.explode("items").alias("item"))
    within = whole.join(part, ["item", "verdict"]).where("short_size < size AND short_confidence >= confidence")
    within = within.groupBy("key", "verdict", "short").agg(F.count("*").alias("hits"), F.first("short_size").alias("short_size"))
    fallen = within.where("hits = short_size").select("key", "verdict").distinct()
    kept = cut_lineage(rules.join(fallen, ["key", "verdict"], "left_anti"))
    held = kept.select("key", "verdict", F.explode("items").alias("name")).join(classes, "name")
    held = held.groupBy("key", "verdict").agg(F.array_sort(F.collect_list(F.struct("name", "members")))["members"].alias("members"))
    number = F.row_number().over(Window.orderBy(F.desc("confidence"), F.desc("support"), "size", "key", "verdict"))
    return cut_lineage(kept.join(held, ["key", "verdict"]).select(number.alias("rule_id"), "items", "members", "verdict", "confidence", "support", "size"))


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(signature, verdict) of the first rule, by confidence, then support, that a set holds: a member of each item.

    ``sets`` has distinct ``signature`` (text) and ``items``; sets that hold no rule have no row.
    """
    index = rules.select("rule_id", "size", F.posexplode("members").alias("place", "members"))
    index = index.select("rule_id", "size", "place", F.explode("members").alias("item"))
    held = sets.select("signature", F.explode("items").alias("item")).join(index, "item")
    held = held.select("signature", "rule_id", "size", "place").distinct()
    held = held.groupBy("signature", "rule_id").agg(F.count("*").alias("hits"), F.first("size").alias("size")).where("hits = size")
    best = held.groupBy("signature").agg(F.min("rule_id").alias("rule_id"))
    return best.join(rules.select("rule_id", "verdict"), "rule_id").select("signature", "verdict")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    A page that a fixed rule fits has that rule's verdict, and the distinct URLs of such pages are the labels.
    The others go by the mined rule of most confidence, then support, that they hold; without one, or without
    labels, by ``DEFAULT``. Null URLs and URLs without ``://`` have an empty host and path, and the default.
    Repeated rows are judged each. An empty table gives no rows.
    """
    rows = pages.select(pages["page_id"].alias("page_id"), host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    rows = fixed_verdicts(rows, rules).withColumn("items", tokens())
    labelled = rows.where("rule_verdict IS NOT NULL").select("host", "path", "items", F.col("rule_verdict").alias("verdict")).distinct()
    mined = mine_rules(labelled, support, confidence)
    # only tokens of rules tell sets apart: a bounded number, since each stands in a share of the labels
    known = mined.select(F.explode(F.flatten("members")).alias("item")).distinct().orderBy("item")
    wanted = _literals([r["item"] for r in known.collect()])
    held = F.array_sort(F.array_intersect(F.when(F.col("rule").isNull(), F.col("items")).otherwise(F.array().cast("array<string>")), wanted))
    rows = rows.withColumn("held", held).withColumn("signature", F.array_join("held", "\n"))
    sets = rows.where("signature <> ''").select("signature", F.col("held").alias("items")).distinct()
    matched = match_rules(sets, mined).withColumnRenamed("verdict", "mined")
    out = rows.join(matched, "signature", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "mined", F.lit(DEFAULT)).alias("verdict"))
