"""A training corpus from the table of documents: filter, deduplicate twice, mix, pack.

Each stage takes the rows that its predecessor kept, with the columns of documents, and the last returns the
packed pieces. Between stages the rows are a Parquet table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.llm import jaccard, mixing, packing, queries, suffix, toxicity
from waferline.llm.common import carried, table, uncarried
from waferline.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; null and empty texts have no toxic term.

    The classifier learns from labels of ``docs`` that are not held out. Repeated rows go or stay together.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learnable())
    scored = toxicity.score(carried(docs), model, "rest")
    return uncarried(scored.where(F.col("score") < toxicity.THRESHOLD), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Documents without words are linked with nothing and all stay, as do rows with a null doc_id, which
    can't be told from each other. Of rows that repeat a doc_id with words one stays, the first by text.
    """
    found = cut_lineage(jaccard.near_duplicates(docs))
    gone = found.where("n_shingles > 0 AND doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = cut_lineage(found.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if not repeated.isEmpty():
        one = carried(kept.join(repeated, "doc_id", "left_semi")).groupBy("doc_id").agg(F.min(F.struct("text", "rest")).alias("row"))
        one = uncarried(one.select("doc_id", "row.text", "row.rest"), docs)
        kept = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
    return kept.select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the bytes of passages that start earlier too; ``n_chars`` is counted anew.

    A document that loses every byte stays, with an empty text; null texts become empty.
    """
    rows = suffix.remove_repeats(carried(docs))
    size = {"n_chars": F.length("text").cast("bigint")} if "n_chars" in docs.columns else {}
    return uncarried(rows.select("doc_id", "text", "rest"), docs, **size)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix has copies of it, none of those without one."""
    mix = mixing.solve(cut_lineage(mixing.measured(docs)))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    sized = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), mixing.source_key(docs["source"]).alias("skey"), mixing.size_of(docs["text"]).alias("size"), row)
    rows = mixing.add_copies(sized, mix).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, and their places in sequences."""
    return packing.pack(packing.token_pieces(docs, queries.vocabulary()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier, components and packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
