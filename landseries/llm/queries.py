"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landseries.llm import embedding_dedup, importance, langid, line_dedup, nearest, packing, periodic_runs, quality, sentencepiece_lattice, simhash, substring_dedup, suffix_tree, webp
from landseries.llm.common import long_texts, staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    long_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.place(staged(packing.pieces(table(spark, sf_dir, "documents"))))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).drop("bits_per_byte")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the pieces, and say whether the text came back."""
    docs = table(spark, sf_dir, "documents")
    decoded = sentencepiece_lattice.decode(sentencepiece_lattice.encode(docs))
    return decoded.select("doc_id", "n_pieces", "ids_crc32", F.length("text").cast("long").alias("n_chars"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op7_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.matched_lines(table(spark, sf_dir, "documents"))


def op9_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_webp_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.digest(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


def op12_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_best_fit_packing, op2_quality_gam, op3_substring_dedup, op4_language_id, op5_embedding_near_dedup,
        op6_sentencepiece, op7_suffix_tree_lm, op8_line_dedup, op9_simhash_ball, op10_webp_media,
        op11_periodic_runs, op12_multi_index_hashing, op13_importance_resampling,
    )
    return {f.__name__: f for f in found}


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.x, b.x) / (sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))) >= 0.93
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), low AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(low.m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN low ON low.a = e.vec_id
"""

OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, list_sort(list_distinct(list_filter(
    regexp_split_to_array(translate(string_split(text, chr(10))[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS words
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), c AS (
  SELECT words, min((doc_id, line_no)) AS first, count(*) AS copies, row_number() OVER () AS id FROM l WHERE len(words) > 0 GROUP BY words
), w AS (SELECT id, unnest(words) AS word, len(words) AS n FROM c),
p AS (
  SELECT a.id AS x, b.id AS y FROM w a JOIN w b ON a.word = b.word AND a.id <> b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), k AS (
  SELECT c.id, c.words, least(c.first, coalesce(min(o.first), c.first)) AS first, c.copies - 1 + coalesce(sum(o.copies), 0) AS n_links
  FROM c LEFT JOIN p ON p.x = c.id LEFT JOIN c o ON o.id = p.y GROUP BY c.id, c.words, c.first, c.copies
)
SELECT l.doc_id, l.line_no, CAST(k.n_links AS BIGINT) AS n_links, k.first[1] AS first_doc, k.first[2] AS first_line,
       (l.doc_id, l.line_no) <> k.first AS removed
FROM l JOIN k ON l.words = k.words
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_embedding_near_dedup": OP5_SQL, "op8_line_dedup": OP8_SQL}
