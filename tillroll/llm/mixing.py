"""Mixing sources to target weights by Pfair scheduling, in DataFrame expressions only.

Every source's documents are put in a fixed random order (md5 of the id) and cut into blocks.
Target weights are whole shares ``q`` of a period of ``Q`` slots.  Block j (from 1) of a source may
not start before slot ``floor((j-1)·Q/q)`` and must end by slot ``ceil(j·Q/q)``; the released block
with the earliest deadline gets the slot.  Shares add up to Q, so every block meets its window, and
after any number of slots a source is less than one block away from its target, until its blocks run
out (its later slots then stay empty; no document is dropped or repeated).

The windows of the next period are those of this one, shifted by Q, so only one period is scheduled
(max(1024, 2 x sources) rows, broadcast) and a document's slot follows from its rank in its source.

The rank never puts a source in one task: a source of n documents has about sqrt(n) ranges of the
md5 order with about sqrt(n) documents each; ranges are counted, counts are summed, and only ranges
are sorted.

Defined results: a null source is a source of its own.  Null or repeated ids are ordinary rows: ties
of the md5 order fall to the id and the row's other columns.  An empty table gives an empty result.
Input columns are passed through; the added ones replace input columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_DOCS = 16
PERIOD_SLOTS = 1024
ADDED = ("source_share", "period_slots", "source_rank", "block", "slot", "in_block")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def root_weights(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """Default targets: weight = whole square root of the source's size, between even and natural."""
    return (docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
            .select("source", F.floor(F.sqrt("n")).cast("long").alias("weight")))


def whole_shares(weights: DataFrame, period: int = PERIOD_SLOTS) -> DataFrame:
    """Shares of max(period, 2 x sources) slots, one at least for each source, the rest in proportion
    to the whole-number weights by largest remainder (ties: smaller source, null first)."""
    one = weights.select(_source_key(F.col("source")).alias("src"), F.col("weight").cast("long").alias("weight"))
    total = one.agg(F.count(F.lit(1)).alias("s"), F.sum("weight").alias("w"),
                    F.greatest(F.lit(period), 2 * F.count(F.lit(1))).alias("period"))
    x = one.crossJoin(F.broadcast(total)).select(  # the right side is one row
        "src", "period", "s", (F.col("weight") * (F.col("period") - F.col("s"))).alias("p"), "w")
    x = x.select("src", "period", (1 + F.expr("p div greatest(w, 1L)")).alias("q"), (F.col("p") % F.greatest("w", F.lit(1))).alias("rest"))
    short = F.col("period") - F.sum("q").over(W.partitionBy("period"))
    place = F.row_number().over(W.partitionBy("period").orderBy(F.col("rest").desc(), "src"))
    return x.select("src", "period", (F.col("q") + F.when(place <= short, 1).otherwise(0)).alias("q"))


def one_period(shares: DataFrame) -> DataFrame:
    """Earliest deadline first over one period: rows (src, q, period, j, slot), j from 1 to q."""
    row = shares.groupBy("period").agg(F.sort_array(F.collect_list(F.struct("src", "q"))).alias("all"))
    row = row.withColumn("slots", F.expr("""
        aggregate(sequence(0L, period - 1),
          named_struct('next', transform(all, x -> 1L), 'out', cast(array() as array<struct<i:int,j:bigint,slot:bigint>>)),
          (state, t) -> element_at(transform(
            array(array_min(filter(transform(state.next, (n, i) ->
              named_struct('deadline', if(n <= all[i].q and ((n - 1) * period) div all[i].q <= t,
                                          (n * period + all[i].q - 1) div all[i].q, null), 'i', i, 'j', n)),
              x -> x.deadline is not null))),
            best -> named_struct(
              'next', transform(state.next, (n, i) -> if(i <=> best.i, n + 1, n)),
              'out', if(best is null, state.out, concat(state.out, array(named_struct('i', best.i, 'j', best.j, 'slot', t)))))), 1),
          state -> state.out)"""))
    return (row.select("period", "all", F.explode("slots").alias("x"))
            .select(F.expr("all[x.i].src").alias("src"), F.expr("all[x.i].q").alias("q"), "period",
                    F.col("x.j").alias("j"), F.col("x.slot").alias("slot")))


def ranks_in_source(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """Rows (row, src, rank): the input row as a struct, so that its columns may have any name, and its rank in its source
    (from 0, in md5 order of the id), without sorting a whole source."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    digest = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary"))
    d = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), _source_key(F.col(f"`{source_col}`")).alias("src"), digest.alias("md5"))
    sizes = d.groupBy("src").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("ranges"))
    # first 32 bits of the digest, cut into the source's number of equal ranges
    d = d.join(F.broadcast(sizes), "src").withColumn(
        "range", F.expr("(cast(conv(substring(md5, 1, 8), 16, 10) as bigint) * ranges) div 4294967296L"))
    counts = d.groupBy("src", "range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("src", "range", (F.sum("n").over(
        W.partitionBy("src").orderBy("range").rowsBetween(W.unboundedPreceding, -1))).alias("before"))
    local = F.row_number().over(W.partitionBy("src", "range").orderBy("md5", "id", F.xxhash64("row"))) - 1
    return d.join(before, ["src", "range"]).select("row", "src", (F.coalesce("before", F.lit(0)) + local).cast("long").alias("rank"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
                source_col: str = "source", block_docs: int = BLOCK_DOCS,
                period: int = PERIOD_SLOTS) -> DataFrame:
    """``docs`` with ``source_share`` of ``period_slots``, ``source_rank`` (from 0), ``block`` (from
    1), global ``slot`` and ``in_block``; the mixed order is (slot, in_block).

    ``weights``: rows (source, weight) with whole weights; a source without one, or with 0, gets the
    least share, one slot a period; default ``root_weights``.  The sizes, shares and period tables have one row a source or slot."""
    docs = docs.drop(*[c for c in ADDED if c not in (id_col, source_col)])
    source = F.col(f"`{source_col}`")
    if weights is None:
        weights = root_weights(docs, source_col)
    else:
        there = docs.select(_source_key(source).alias("k"), source.alias("source")).distinct()
        given = weights.groupBy(_source_key(F.col("source")).alias("k")).agg(F.sum("weight").alias("weight"))
        weights = there.join(given, "k", "left").select("source", F.coalesce("weight", F.lit(0)).alias("weight"))
    schedule = one_period(whole_shares(weights, period))
    shares = schedule.select("src", "q", "period").distinct()
    d = ranks_in_source(docs, id_col, source_col).withColumn("b", F.expr(f"rank div {block_docs}"))
    d = d.join(F.broadcast(shares), "src").withColumn("j", F.col("b") % F.col("q") + 1)
    d = d.join(F.broadcast(schedule.select("src", "j", "slot")), ["src", "j"])
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ADDED]
    return d.select(*kept, F.col("q").alias("source_share"), F.col("period").alias("period_slots"), F.col("rank").alias("source_rank"),
                    (F.col("b") + 1).alias("block"), (F.expr("b div q") * F.col("period") + F.col("slot")).alias("slot"),
                    (F.col("rank") % block_docs).cast("int").alias("in_block"))


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """Rows in files of rising slots, sorted within each."""
    return mixed.repartitionByRange("slot", "in_block").sortWithinPartitions("slot", "in_block")
