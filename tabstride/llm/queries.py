"""The queries of the operators over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.llm import (
    bpe, config_packing, embeddings, html, importance, interactions, licenses, neardup, packing,
    quality, quotes, spans, urls,
)
from tabstride.llm.oracles import ORACLES  # noqa: F401


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, locality=["source"], with_ids=False)


def op2_minhash(spark: SparkSession, sf: str) -> DataFrame:
    rules = neardup.NearDup(shingle=3, percent=85)
    return neardup.near_duplicates(_documents(spark, sf), rules=rules)


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return spans.drop_repeats(_documents(spark, sf), rules=spans.WHOLE)


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf)).drop("places")


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(_documents(spark, sf), path, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repetition_profile(_documents(spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf}/pages.parquet"))


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf}/pages.parquet"))


def op9_quotation_linking(spark: SparkSession, sf: str) -> DataFrame:
    return quotes.link_replies(spark.read.parquet(f"{sf}/conversations.parquet"))


def op10_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return importance.resample(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return interactions.filter_audit(docs, spark.read.parquet(f"{sf}/labels.parquet"))


def op13_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return config_packing.pack_best_fit(_documents(spark, sf), path, with_ids=False)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_minhash,
        op3_substring_dedup,
        op4_license_scan,
        op5_bpe,
        op6_quality_rules,
        op7_html_extraction,
        op8_url_filter,
        op9_quotation_linking,
        op10_embedding_dedup,
        op11_importance_resampling,
        op12_filter_audit,
        op13_best_fit_packing,
    )
}
