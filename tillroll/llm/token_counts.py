"""Token counts through a digest cache.

A text's key is the digest of its content as the tokenizer sees it (null counts as empty; the
tokenizer's own normaliser runs inside it, so nothing else may be folded without changing counts),
together with the digest of the tokenizer's model.  Keys are joined to the cache, a Parquet table
(content, tokenizer, n_tokens) in shared storage; one text of each missing key is encoded, and
the new counts are appended to the cache.

Plan: one shuffle of the distinct texts by digest, after a partial aggregation in each map task, so
a text that a third of the rows share reaches its reducer once a task; counts are joined back to
(id, size, digest) rows without text, where adaptive execution splits a hot digest.

Defined results: null or empty text: 0 bytes and the tokenizer's count of "".  Null or repeated ids
pass through, a count for each row.  Extra columns are ignored, whatever their names.  An empty
table gives an empty result and leaves the cache as it is.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import new_folder
from tillroll.llm.rows import map_slices

MAX_TOKENS = 4096
MAX_HOT, LEAST_HOT, SALTS = 1000, 256, 64  # hot digests at most; copies at least; parts of a hot digest
CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


class Counter:
    """A tokenizer file's bytes (read on the driver, of fixed size) and their digest.  Files ending in
    ``.model`` belong to sentencepiece, ``.json`` to tokenizers."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = f.read()
        self.kind = "tokenizers" if path.endswith(".json") else "sentencepiece"
        self.version = hashlib.sha256(self.kind.encode() + b"\0" + self.data).hexdigest()

    @staticmethod
    def open(kind: str, data: bytes):
        """texts -> counts, without begin, end or added special tokens, truncation or padding."""
        if kind == "tokenizers":
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            t = Tokenizer.from_str(data.decode())
            t.no_truncation()
            t.no_padding()
            return lambda texts: [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
        from sentencepiece import SentencePieceProcessor
        p = SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(p.encode(x)) for x in texts]


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache, empty if nothing has been written yet (asked of the path's own file system)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    reader = spark.read.schema(CACHE_SCHEMA)
    return reader.parquet(cache) if there else spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(docs: DataFrame, tokenizer: Counter, cache: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit).  ``cache``: its folder in shared storage; a new
    one where none is given.  Encoding and appending run at once, the final join on use.

    A call that dies while appending leaves whole files or none (the committer's rename); two calls
    at once may both append a key, so the cache is read with duplicates removed."""
    spark = docs.sparkSession
    cache = cache or new_folder(spark, "token-cache")
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                    F.unhex(F.sha2(text.cast("binary"), 256)).alias("content"), text.alias("text"))

    def known() -> DataFrame:
        one = read_cache(spark, cache).where(F.col("tokenizer") == tokenizer.version)
        return one.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    misses = (d.groupBy("content").agg(F.first("text").alias("text"))
              .join(known().select("content"), "content", "left_anti"))
    shared = spark.sparkContext.broadcast({"kind": tokenizer.kind, "data": tokenizer.data})
    version = tokenizer.version

    def make():
        own = shared.value  # stays in the worker: the model is opened once there
        count = own.get("count") or own.setdefault("count", Counter.open(own["kind"], own["data"]))
        return lambda rows: {"content": rows["content"], "tokenizer": [version] * len(rows["text"]),
                             "n_tokens": count(rows["text"].to_pylist())}

    map_slices(misses, make, CACHE_SCHEMA).write.mode("append").parquet(cache)
    rows = d.drop("text")
    sizes = rows.groupBy("content").agg(F.count(F.lit(1)).alias("copies"))
    least = max(LEAST_HOT, docs.count() // MAX_HOT)
    hot = F.broadcast(sizes.where(F.col("copies") > least).select("content", F.lit(True).alias("hot")))
    rows = rows.join(hot, "content", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "n_bytes"), F.lit(SALTS)).cast("int")).otherwise(0))
    counts = known().join(hot, "content", "left").select(
        "content", "n_tokens", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return rows.join(counts, ["content", "salt"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"))
