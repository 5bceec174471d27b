"""Whole-table orders without a single-partition window.

A window with an ORDER BY and no PARTITION BY makes Spark move every row into
one task.  ``global_prefix`` gives the same running sums and row numbers in
parallel:

1. the input is staged (written to shared storage) so the jobs below read the same rows, and a lost
   executor reads them again rather than recomputing the raw scan;
2. range partitioning cuts the order into ``B`` buckets of about ROWS_PER_BUCKET rows, as many as the
   rows need; the rows are written with their bucket's number;
3. a window partitioned by bucket gives local row numbers and running sums;
4. per-bucket totals (``B`` rows) are turned into offsets and broadcast.

The order must be total (unique on the order columns) when row numbers are
used; equal tuples always share a bucket, so ties stay together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import INT, int_div
from tillroll.session import staged, unstage

ROWS_PER_BUCKET = 2_000_000
MIN_BUCKETS = 8


class Key:
    """One sort key: column name, direction and NULL placement."""

    def __init__(self, name: str, ascending: bool = True, nulls_last: bool | None = None):
        self.name = name
        self.ascending = ascending
        # SQL default: NULLs last ascending, first descending (as PostgreSQL).
        self.nulls_last = ascending if nulls_last is None else nulls_last

    def sort_col(self) -> Column:
        c = F.col(self.name)
        if self.ascending:
            return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()
        return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()


def asc(name: str, nulls_last: bool = True) -> Key:
    return Key(name, True, nulls_last)


def desc(name: str, nulls_last: bool = False) -> Key:
    return Key(name, False, nulls_last)


def bucket_count(n: int) -> int:
    """About ROWS_PER_BUCKET rows a bucket, MIN_BUCKETS at least; as many as the rows need."""
    return max(MIN_BUCKETS, math.ceil(n / ROWS_PER_BUCKET))


def range_buckets(df: DataFrame, keys: list[Key], n: int, n_buckets: int | None = None,
                  out: str = "_bucket") -> DataFrame:
    """Add a bucket column that is monotone in the order of ``keys``; rows that are equal on the keys
    share a bucket.  Spark's range partitioning cuts the buckets; they are written with their numbers,
    so every later job sees the same ones."""
    b = n_buckets or bucket_count(n)
    dealt = df.repartitionByRange(b, *[k.sort_col() for k in keys])
    return staged(dealt.withColumn(out, F.spark_partition_id()), "buckets")


def global_prefix(df: DataFrame, keys: list[Key], sum_cols: list[str] = (),
                  n_buckets: int | None = None, materialize: bool = True,
                  row_no: str = "row_no", n_rows: str = "n_rows",
                  running: str = "running_", total: str = "total_", n: int | None = None) -> DataFrame:
    """Add ``row_no`` (1-based position in the order), ``n_rows``, and for
    each column c of ``sum_cols``: ``running_c`` (sum from the first row to
    this one) and ``total_c`` (sum over the whole table).

    ``n``: the row count when the caller already knows it (skips a job)."""
    if materialize:
        df = staged(df, "ordered")
    if n is None:
        n = df.count()
    bucketed = range_buckets(df, keys, n, n_buckets)
    if materialize:
        unstage(df)  # the buckets hold its rows

    w = Window.partitionBy("_bucket").orderBy(*[k.sort_col() for k in keys])
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = bucketed.withColumn("_local_rn", F.row_number().over(w))
    for c in sum_cols:
        local = local.withColumn(f"_local_{c}", F.sum(c).over(frame))
    totals = bucketed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_b_cnt"), *[F.sum(c).alias(f"_b_{c}") for c in sum_cols])
    # A row a bucket, n / ROWS_PER_BUCKET of them: a one-partition window on a tiny table, broadcast.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    offsets = totals.select(
        "_bucket",
        F.coalesce(F.sum("_b_cnt").over(before), F.lit(0)).alias("_off_cnt"),
        *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_b_{c}").over(whole).alias(f"_tot_{c}") for c in sum_cols],
    )
    out = local.join(F.broadcast(offsets), "_bucket")
    cols = [F.col(c) for c in df.columns]
    cols.append((F.col("_local_rn") + F.col("_off_cnt")).cast("bigint").alias(row_no))
    cols.append(F.lit(n).cast("bigint").alias(n_rows))
    for c in sum_cols:
        cols.append((F.coalesce(F.col(f"_local_{c}"), F.lit(0)) + F.col(f"_off_{c}")).alias(f"{running}{c}"))
        cols.append(F.col(f"_tot_{c}").alias(f"{total}{c}"))
    return out.select(*cols)


def cume_counts_many(df: DataFrame, values: list[str], outs: list[str], n: int,
                     n_buckets: int | None = None) -> DataFrame:
    """CUME_DIST's numerator (rows at or before this one's value) for several columns with one
    ordering pass over their distinct values, so heavy ties cost one row each.

    The (column index, value) pairs of all columns are counted together and
    put in one order; column k's pairs follow the n rows of columns 0..k-1,
    so its at-or-before count is the running count minus k·n.  The small
    distinct table is staged and joined back once per column (AQE
    broadcasts the joins whose side is small at run time)."""
    vtype = "decimal(38,6)"
    pairs = F.array(*[F.struct(F.lit(i).alias("_k"), F.col(v).cast(vtype).alias("_v"))
                      for i, v in enumerate(values)])
    counts = (df.select(F.explode(pairs).alias("_p")).select("_p._k", "_p._v")
              .groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_cnt")))
    pref = global_prefix(counts, [asc("_k"), asc("_v")], ["_cnt"], n_buckets)
    pref = pref.select("_k", "_v", (F.col("running__cnt") - F.col("_k") * F.lit(n)).alias("_le"))
    pref = staged(pref, "counts")
    out = df
    for i, (v, o) in enumerate(zip(values, outs)):
        look = pref.where(F.col("_k") == i).select(F.col("_v").alias(f"_v{i}"), F.col("_le").alias(o))
        out = out.join(look, out[v].cast(vtype).eqNullSafe(look[f"_v{i}"]), "left").drop(f"_v{i}")
    return out


def quantile_score(rank_no: Column, n: Column, q: int = 5) -> Column:
    """Bin 1..q of a 1-based rank among n by equal-width cuts of 1..n
    (right-closed, first bin closed on the left): max(1, ceil(q(rank-1)/(n-1)))."""
    a = ((rank_no - 1) * q).cast(INT)
    b = F.greatest(n - 1, F.lit(1)).cast(INT)
    score = int_div(a + b - 1, b)
    return F.when(n <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), score.cast("int"))).cast("int")
