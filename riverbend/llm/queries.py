"""Registered queries of the training-data operators; their DuckDB SQL, where there is one, is in ``oracle``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm import (
    fim,
    html_text,
    langid,
    packing,
    pieces,
    quality,
    sharding,
    simhash,
    token_counts,
    topk,
    toxicity,
    vector_codes,
    warc,
)
from riverbend.llm.common import held_out, table, written
from riverbend.llm.oracle import ORACLE

PIECES = "piece_bpe_32k.model"


def _pieces() -> bytes:
    import public_tokenizers  # where it is installed; the other queries need none

    return pieces.read_model(public_tokenizers.path(PIECES))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, max_bits=4)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents")).drop("char_js", "word_js")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", held_out("doc_id", *langid.HOLD).alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out("doc_id", *toxicity.HOLD).alias("held_out"), "score", "predicted")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), _pieces())


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents: loaded with estimated counts (bytes / 4), then revised to the
    tokenizer's; the bytes themselves are a second version; the revision, sent again, adds nothing."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = written(pieces.counts(docs, _pieces(), keep=("source", "lang", "n_bytes"))
                      .withColumn("estimate", F.ceil(F.col("n_bytes") / 4)), "counted")
    rollup = token_counts.rollup(spark, uuid.uuid4().hex)
    rollup.commit("load", token_counts.inserts(counted, "piece_bpe_32k", "estimate").unionByName(
        token_counts.inserts(counted, "utf8_bytes", "n_bytes")))
    revised = token_counts.revisions(counted, "piece_bpe_32k", "estimate", "n_tokens")
    rollup.commit("revise", revised)
    rollup.commit("revise", revised)
    return rollup.totals()


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    read = warc.records(spark, warc.archive(pages), pages.schema["page_id"].dataType.simpleString())
    return read.drop("payload")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(*vector_codes.encode(table(spark, sf_dir, "embeddings")))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_sharding, op3_simhash_near_dedup, op4_html_extraction, op5_quality_rules,
    op6_exact_top_k, op7_language_id, op8_toxicity, op9_sentencepiece, op10_token_counts, op11_fill_in_middle, op12_warc, op13_vector_codes)}

__all__ = ["ORACLE", "QUERIES"]
