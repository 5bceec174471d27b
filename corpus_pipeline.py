"""A corpus pipeline: documents in, token ids' digests out.

Stages, each over all that the one before kept: quality classifier, line quality rules,
near-duplicate removal, mixing of sources, byte-level BPE.  A stage takes (spark, docs, sf_dir);
its result is written as Parquet in the shared folder and read again as the next stage's docs.  All but
the last return the columns that they were given.

Defined results, beside the operators' own: every row is scored and judged by its own text, also where
its id is null or repeats (an empty text fails the quality rules, so it does not get past the second
stage); of rows that are near duplicates one stays, whatever their ids.
Extra columns are carried along, whatever their names.  Empty tables give an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, mixing, near_dups, quality_model, quality_rules
from tillroll.llm.common import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.good_documents(docs, labels)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failing lines; ``n_chars`` follows the text."""
    kept = quality_rules.cleaned_documents(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id (null last), of each near-duplicate group of rows."""
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = staged(docs.select(packed, F.monotonically_increasing_id().alias("number")), "rows", "zstd")  # written once: row numbers stay
    texts = rows.select("number", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    groups = near_dups.near_duplicates(texts.drop("doc_id"), id_col="number").select(F.col("doc_id").alias("number"), "component_id")
    ids = texts.select("number", "doc_id", F.xxhash64("text").alias("text"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text", "number")
    first = groups.join(ids, "number").groupBy("component_id").agg(F.min(order).alias("first"))
    kept = rows.join(first.select(F.col("first.number").alias("number")), "number", "left_semi")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files of the mixed order."""
    packed = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return mixing.in_mixed_order(mixing.mix_sources(packed)).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    vocabulary = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(docs, vocabulary)


STAGES = [
    ("quality classifier", keep_quality),
    ("quality rules", clean_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]

#: The classifier and the encoder can't be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


def all_queries() -> dict:
    return {"pipeline": run}


def all_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
