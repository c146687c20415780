"""Corpus pipeline: language, quality, near-duplicates, packing.

Each stage takes the documents that its predecessor kept, written as Parquet and read
again. All but the last return the columns of ``documents``; the last one the packing plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverbend.llm import langid, packing, quality, simhash
from riverbend.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with less than half of their letters in one, go."""
    return langid.keep_identified(docs, langid.train(docs), min_score=0.5)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language's references go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest id."""
    return simhash.keep_one(docs, width=4, max_bits=4)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("best_fit_packing", best_fit_packing)]

#: Viterbi spans, fingerprints and the sequential packing have no SQL form; tests/llm holds a
#: brute-force pipeline against this one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
