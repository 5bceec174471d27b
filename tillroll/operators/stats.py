"""Exact percentiles and ``describe`` without gathering or sorting a group.

``percentile``/``median`` aggregates keep every value of a group in one
buffer, so a global median of a billion-row table would run in one task.
Here wanted places are found by selection: a histogram of ``BINS`` equal bins
between a group's smallest and largest value says which bin covers a place; the
bin's own smallest and largest values are the next bounds, and so on until they
are equal.  A round is one filtered scan of the group's distinct values and one
aggregate that is combined in each task; no value is sorted or range-partitioned.
Bounds are always values of the data, and the smallest and the largest fall into
different bins, so every round narrows; a handful of rounds is usual.

Interpolation is linear between the neighbours (position (n - 1) p), the
definition shared by pandas, numpy, DuckDB ``quantile_cont`` and Spark
``percentile``.  With DECIMAL input it is exact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillroll.functions.numeric import ratio_half_up, round_double, unscaled
from tillroll.session import staged

BINS = 1024
MAX_BROADCAST = 100_000  # bounds of groups


def pct_name(p: float) -> str:
    return f"p{int(round(p * 100)):02d}"


def selected_values(counts: DataFrame, value: str, wanted: DataFrame, group_cols: list[str], bins: int = BINS) -> DataFrame:
    """(group columns, _n, _place, _value): the value that covers each wanted 0-based place of a group's order.

    ``counts``: a written table of a group's distinct values and their rows ``_cnt``.  ``wanted``: (group columns, _n,
    _place, _low, _high), with the group's smallest and largest value."""
    names = [*group_cols, "_n", "_place", "_low", "_high", "_before"]
    bounds = [*group_cols, "_low", "_high"]
    span = F.col("_low") < F.col("_high")

    def written(df):
        seen = Observation()
        out = staged(df.select(*names).observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(span).alias("open")), "places")
        return out, seen.get["all"], seen.get["open"]

    places, n, n_open = written(wanted.withColumn("_before", F.lit(0).cast("bigint")))
    while n_open:
        still = places.where(span)
        ranges = still.select(*bounds).distinct()
        ranges = F.broadcast(ranges) if n <= MAX_BROADCAST else ranges
        v, c, r = F.col(f"c.{value}"), counts.alias("c"), ranges.alias("r")
        inside = v.between(F.col("r._low"), F.col("r._high"))
        for g in group_cols:
            inside = (F.col(f"c.{g}") == F.col(f"r.{g}")) & inside
        share = (v - F.col("r._low")).cast("double") / (F.col("r._high") - F.col("r._low")).cast("double")
        binned = c.join(r, inside).select(
            *[F.col(f"r.{b}").alias(b) for b in bounds], v.alias("_v"), "_cnt",
            F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int").alias("_bin"))
        histogram = binned.groupBy(*bounds, "_bin").agg(
            F.sum("_cnt").alias("_k"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
        earlier = Window.partitionBy(*bounds).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # a row a bin
        histogram = histogram.withColumn("_ahead", F.coalesce(F.sum("_k").over(earlier), F.lit(0)))
        at = F.col("_place") - F.col("_before") - F.col("_ahead")
        narrowed = still.join(histogram, bounds).where((at >= 0) & (at < F.col("_k"))).select(
            *group_cols, "_n", "_place", F.col("_first").alias("_low"), F.col("_last").alias("_high"),
            (F.col("_before") + F.col("_ahead")).alias("_before"))
        places, n, n_open = written(narrowed.unionByName(places.where(~span)))
    return places.select(*group_cols, "_n", "_place", F.col("_low").alias("_value"))


def exact_percentiles(df: DataFrame, value: str, pcts: list[float], group_cols: list[str] = (),
                      names: list[str] | None = None, n_buckets: int | None = None) -> DataFrame:
    """One row per group: group columns + one column per percentile (NULL values and groups skipped).  ``n_buckets``: bins
    of a round."""
    names = names or [pct_name(p) for p in pcts]
    group_cols = list(group_cols)
    d = df.where(F.col(value).isNotNull())
    for c in group_cols:
        d = d.where(F.col(c).isNotNull())
    # A row a distinct value: what is scanned doesn't grow with ties.
    d = staged(d.groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_cnt")), "values")
    positions = {}
    for p, name in zip(pcts, names):
        pos = (F.col("_n") - 1).cast("decimal(20,0)") * F.lit(Decimal(str(p)))
        lo = F.floor(pos).cast("bigint")
        positions[name] = (lo, F.ceil(pos).cast("bigint"), pos - lo)
    groups = d.groupBy(*group_cols).agg(F.sum("_cnt").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high")).where("_n > 0")
    places = F.array_distinct(F.array(*[x for lo, hi, _ in positions.values() for x in (lo, hi)]))
    found = selected_values(d, value, groups.withColumn("_place", F.explode(places)), group_cols, n_buckets or BINS)
    aggs = []
    for name, (lo, hi, frac) in positions.items():
        aggs += [F.max(F.when(F.col("_place") == lo, F.col("_value"))).alias(f"_{name}_lo"),
                 F.max(F.when(F.col("_place") == hi, F.col("_value"))).alias(f"_{name}_hi"),
                 F.max(frac).alias(f"_{name}_f")]
    g = found.groupBy(*group_cols).agg(*aggs)
    vtype = df.schema[value].dataType
    out = [F.col(c) for c in group_cols]
    for p, name in zip(pcts, names):
        lo_v, hi_v, f = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_f")
        if isinstance(vtype, DecimalType):
            # Narrow the operands so the product keeps every digit (no
            # precision-loss rescaling): value scale s, fraction scale k.
            k = max(0, -Decimal(str(p)).normalize().as_tuple().exponent)
            s = vtype.scale
            v = f"decimal({min(vtype.precision, 33 - k)},{s})"
            lo_v, hi_v = lo_v.cast(v), hi_v.cast(v)
            f = f.cast(f"decimal({k + 1},{k})")
            out.append((lo_v + (hi_v - lo_v) * f).cast(f"decimal(38,{s + k})").alias(name))
        else:
            lo_v, hi_v = lo_v.cast("double"), hi_v.cast("double")
            out.append((lo_v + (hi_v - lo_v) * f.cast("double")).alias(name))
    return g.select(*out)


def medians_by(df: DataFrame, group_cols: list[str], cols: list[str], vtype: str,
               names: list[str] | None = None, p: float = 0.5, n_buckets: int | None = None) -> DataFrame:
    """Exact percentile ``p`` of several columns per group at once:
    the columns are stacked as (metric, value), selected from with the metric as
    an extra group key, and pivoted back (one column per input column)."""
    names = names or [f"median_{c}" for c in cols]
    stacked = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_metric"), F.col(c).cast(vtype).alias("_value")) for i, c in enumerate(cols)
    ])).alias("_s")).select(*group_cols, "_s._metric", "_s._value")
    q = exact_percentiles(stacked, "_value", [p], list(group_cols) + ["_metric"], names=["_q"], n_buckets=n_buckets)
    return q.groupBy(*group_cols).agg(*[F.max(F.when(F.col("_metric") == i, F.col("_q"))).alias(n)
                                       for i, n in enumerate(names)])


def to_decimal_long(df: DataFrame, cols: list[str], scale: int = 6) -> DataFrame:
    """Unpivot numeric columns to (column, value DECIMAL(38,scale))."""
    typed = df.select(*[F.col(c).cast(f"decimal(38,{scale})").alias(c) for c in cols])
    return typed.unpivot([], cols, "column", "value")


def describe_long(df: DataFrame, cols: list[str], pcts: list[float], scale: int = 6,
                  n_buckets: int | None = None) -> DataFrame:
    """Transposed ``describe``: one row per column with count, mean, std
    (sample), min, the percentiles and max.  Mean is exact (rounded once to
    ``scale``), std is rounded to 4 places, percentiles are exact to
    ``scale + 2`` places."""
    long = staged(to_decimal_long(df, cols, scale), "long")
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.sum(unscaled(F.col("value"), scale)).alias("_sum"),
        F.stddev_samp(F.col("value").cast("double")).alias("_std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    basic = basic.select(
        "column", "count",
        ratio_half_up(F.col("_sum"), F.col("count") * F.lit(10 ** scale), scale, precision=38).alias("mean"),
        round_double(F.col("_std"), 4).alias("std"),
        "min", "max",
    )
    names = [pct_name(p) for p in pcts]
    q = exact_percentiles(long, "value", pcts, ["column"], names, n_buckets)
    q = q.select("column", *[F.col(n).cast(f"decimal(38,{scale + 2})").alias(n) for n in names])
    return basic.join(q, "column", "left").select("column", "count", "mean", "std", "min", *names, "max")
