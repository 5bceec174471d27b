"""Helpers shared by the training-data operators: the shared folder, staged tables, word rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import checkpoint_dir

#: The white space between words, as a Java/RE2 character class body and as a plain string.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"

#: crc32(doc_id as text) mod 4 of the rows whose labels are never learned from.
HELD_OUT = 2


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where the session names
    one; otherwise the session's own checkpoint folder (local sessions only)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or checkpoint_dir(spark)).rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A folder name in the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, several jobs
    can read it with column pruning, and a lost executor loses nothing.  Copies of whole texts are written
    with ``zstd``, which takes two thirds of the space."""
    path = new_folder(df.sparkSession, tag)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_few(df: DataFrame, tag: str, rows: int, rows_a_file: int = 200_000) -> DataFrame:
    """``staged`` in as few files as about so many narrow rows need: iterations over a small table write one file a round,
    not one a shuffle partition."""
    return staged(df.coalesce(max(1, -(-rows // rows_a_file))), tag)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts have none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, f"[{SPACE_CLASS}]+"))


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text mod 4; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0)).cast("int")


def held_out(doc_id: Column) -> Column:
    return fold_of(doc_id) == HELD_OUT


def hash_limit(most: int, n: int) -> int:
    """The 63-bit hash up to which about ``most`` of ``n`` rows lie: four standard deviations fewer are aimed at, so that
    the bound holds."""
    return (1 << 63) - 1 if n <= most else int(max(1, int(most - 4 * most ** 0.5)) / n * (1 << 63))


def bounded_sample(rows: DataFrame, limit: Column, *by: str) -> DataFrame:
    """The rows whose hash of ``by`` is within ``limit`` (``hash_limit``), one row a hash: rows of one hash differ in nothing
    that is learned from.  ``by`` holds the text as well as the id, so rows whose id is null or repeats are chosen
    from like others.  Adds the hash as ``h``."""
    hashed = rows.withColumn("h", F.xxhash64(F.lit(5), *by)).where(F.shiftrightunsigned("h", 1) <= limit)
    return hashed.groupBy("h").agg(F.first(F.struct(*rows.columns)).alias("row")).select("row.*", "h")
