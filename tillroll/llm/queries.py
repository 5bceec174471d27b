"""The registered queries of the training-data operators: one thin query for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (bisectors, bpe, decontamination, language, lexical, mixing, near_dups, oracle, quality_model, quality_rules,
                          token_counts, toxicity, vectors, warc)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).drop("cleaned")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs)


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), vocabulary)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.clusters_with_inertia(_table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.with_digests(decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_source_mix, op3_vector_search, op4_byte_bpe, op5_toxicity, op6_near_dups,
        op7_quality_model, op8_token_counts, op9_warc, op10_language, op11_lexical_search, op12_centroids, op13_decontamination)}


def all_sql() -> dict[str, str]:
    return dict(oracle.SQL)
