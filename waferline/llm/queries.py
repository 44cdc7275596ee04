"""The registered queries of the subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.llm import conversations, jaccard, minhash, mixing, packing, quality, simhash, spelling, suffix, token_files, topk, toxicity, urls
from waferline.llm.common import table
from waferline.session import cut_lineage


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary())
    return packing.pack(pieces)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_lineage(topk.quantised(table(spark, sf_dir, "embeddings")))
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"), 5)


#: Fixed: (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.compare_with_edits(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    left = F.octet_length("kept").cast("bigint")
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - left).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_files(token_files.write_files(table(spark, sf_dir, "documents"), vocabulary()))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_topk": op4_topk,
    "op5_urls": op5_urls,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_mixing": op8_mixing,
    "op9_token_files": op9_token_files,
    "op10_jaccard": op10_jaccard,
    "op11_minhash": op11_minhash,
    "op12_conversations": op12_conversations,
    "op13_spelling": op13_spelling,
}
_OP4 = """WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
  r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_OP7 = """WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
  w AS (SELECT doc_id, i, md5(b[i + 1:i + 100]) AS h FROM (SELECT doc_id, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100) JOIN d USING (doc_id)),
  e AS (SELECT h, min((doc_id, i)) AS low FROM w GROUP BY h HAVING count(*) > 1),
  r AS (SELECT w.doc_id, w.i, coalesce(w.i - lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) > 100, true) AS fresh FROM w JOIN e USING (h) WHERE (w.doc_id, w.i) <> e.low),
  g AS (SELECT doc_id, i, count(*) FILTER (WHERE fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM r),
  s AS (SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM g GROUP BY doc_id, span),
  k AS (SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM s
    UNION ALL SELECT d.doc_id, coalesce(max(s.high), 0), any_value(d.n) FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
  t AS (SELECT doc_id, coalesce(string_agg(hex(b[low + 1:high]), '' ORDER BY low) FILTER (WHERE high > low), '') AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
  c AS (SELECT doc_id, count(*) AS n_spans, sum(high - low) AS gone FROM s GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(c.gone, 0) AS BIGINT) AS n_removed, coalesce(c.n_spans, 0) AS n_spans, sha256(unhex(t.kept)) AS kept_sha256
FROM d JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)"""


def _near_sql(words: int, more: str = "") -> str:
    """Components of sets of shingles: candidates share one of their rarest shingles, then whole sets are compared."""
    following = ", ".join(["x", *[f"lead(x, {i}) OVER o" for i in range(1, words)]])
    return rf"""WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  u AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i, len(w) AS n FROM w),
  v AS (SELECT doc_id, i, n, concat_ws(' ', {following}) AS g FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
  h AS (SELECT DISTINCT doc_id, g FROM v WHERE i <= greatest(n - {words - 1}, 1)),
  s AS (SELECT doc_id, list(g ORDER BY g) AS shingles FROM h GROUP BY doc_id),
  sets AS (SELECT min(doc_id) AS k, shingles, len(shingles) AS n FROM s GROUP BY shingles),
  t AS (SELECT k, n, g FROM sets JOIN h ON k = doc_id),
  f AS (SELECT g, count(*) AS c FROM t GROUP BY g),
  p AS (SELECT k, n, g FROM t JOIN f USING (g) QUALIFY row_number() OVER (PARTITION BY k ORDER BY c, g) <= n - (80 * n + 99) // 100 + 1),
  c AS (SELECT DISTINCT x.k AS a, y.k AS b FROM p x JOIN p y ON x.g = y.g AND x.k < y.k AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
  i AS (SELECT a, b, count(*) AS shared, any_value(x.n) + any_value(y.n) AS both_n FROM c JOIN t x ON a = x.k JOIN t y ON b = y.k AND x.g = y.g GROUP BY a, b),
  l AS (SELECT a, b FROM i WHERE 100 * shared >= 80 * (both_n - shared)),
  e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  r AS (SELECT k AS node, k AS root FROM sets UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
  m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT w.doc_id, CAST(coalesce(sets.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, w.doc_id) AS component_id{more}
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN sets ON s.shingles = sets.shingles LEFT JOIN m ON m.node = sets.k"""


CHECKS: dict[str, str] = {
    "op4_topk": _OP4,
    "op7_suffix_dedup": _OP7,
    "op10_jaccard": _near_sql(jaccard.SHINGLE_WORDS),
    "op11_minhash": _near_sql(2, ", w.doc_id = coalesce(m.root, w.doc_id) AS kept"),
}
