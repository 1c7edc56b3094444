"""From raw documents to packed training sequences: five stages, each one operator with its production parameters.

SQL can't express the stages on word shingles' links (connected components) and on tokens, so there is no SQL for
the whole; tests hold every stage, and the whole, against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.llm import minhash, mixing, packing, quality, substrings
from brindle.llm.common import checkpoint, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: sets of five-word shingles, similarity of 0.8 or more."""
    return minhash.distinct_documents(docs, shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages of 20 words or more that also start earlier go; texts without any keep every byte."""
    return substrings.deduplicated_documents(docs, width=20)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of their curriculum position."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("mix_sources", mix_sources), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each one's result written to the checkpoint folder before the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {}
