"""A corpus clean-up and packing run: each stage takes all documents that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landseries.llm import langid, line_dedup, packing, simhash, substring_dedup
from landseries.llm.common import long_texts, staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told."""
    long_texts(spark)
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that match an earlier line."""
    return line_dedup.remove_later(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-copies."""
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of over 50 words that an earlier document holds."""
    return substring_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut into pieces of up to 2048 tokens and place them in as few sequences as possible."""
    return packing.place(staged(packing.pieces(docs)))


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near_copies), ("substring_dedup", passages), ("best_fit_packing", pack)]

#: No SQL: language models, fingerprints and tokenizers are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
