"""The queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.llm import conversations, embeddings, languages, lines, minhash, mixing, ngrams, packing, phrases, quality, sharding, substrings, urls
from brindle.llm.common import read
from brindle.llm.oracle import ORACLE_SQL


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify_languages(read(spark, sf_dir, "documents"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.katz_scores(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def op3_mixing_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_copies(read(spark, sf_dir, "documents"), carry=("source",))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(read(spark, sf_dir, "documents"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_duplicates(read(spark, sf_dir, "embeddings"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damage(rows), rows)


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_language, op2_katz, op3_mixing, op3_mixing_positions, op4_substrings, op5_embeddings, op6_minhash, op7_quality, op8_urls, op9_packing, op10_sharding, op11_phrases, op12_conversations, op13_lines)}


def oracle_sql() -> dict:
    return dict(ORACLE_SQL)
