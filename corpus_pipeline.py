"""Corpus pipeline: quality rules, near-dedup, substring dedup, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.llm.neardup import keep_one
from tabstride.llm.packing import pack
from tabstride.llm.quality import keep_quality
from tabstride.llm.spans import WHOLE, drop_repeats
from tabstride.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_quality(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences that an earlier document or place has already."""
    cleaned = drop_repeats(docs, rules=WHOLE)
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    return cleaned.withColumn("n_chars", F.coalesce(length, "n_chars")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, path, locality=["source"], with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# Packing has no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None
