"""Property tests: exact rounding helpers against Decimal; hot keys in ranks."""

from decimal import ROUND_HALF_UP, Decimal, getcontext

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.numeric import ratio_half_up, sqrt_half_up
from tillroll.operators.ranks import asc, global_prefix, range_buckets

getcontext().prec = 80


def half_up(x: Decimal, scale: int) -> Decimal:
    q = Decimal(1).scaleb(-scale)
    return x.copy_abs().quantize(q, rounding=ROUND_HALF_UP) * (1 if x >= 0 else -1)


pairs = st.lists(st.tuples(st.integers(-10 ** 12, 10 ** 12), st.integers(-10 ** 6, 10 ** 6)),
                 min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, st.integers(0, 8))
def test_ratio_half_up_property(spark, rows, scale):
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", ratio_half_up(F.col("n"), F.col("d"), scale, precision=30).alias("r")).collect()
    for r in got:
        if r.d == 0:
            assert r.r is None
        else:
            assert r.r == half_up(Decimal(r.n) / Decimal(r.d), scale)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10 ** 14), st.integers(1, 10 ** 6)), min_size=1, max_size=40),
       st.integers(0, 6))
def test_sqrt_half_up_property(spark, rows, scale):
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", sqrt_half_up(F.col("n"), F.col("d"), scale, precision=30).alias("r")).collect()
    for r in got:
        assert r.r == half_up((Decimal(r.n) / Decimal(r.d)).sqrt(), scale)


def test_hot_value_spreads_over_buckets(spark):
    # a third of the rows share one value; the order's tie column splits them
    df = spark.range(30000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
                                   .alias("v"))
    b = range_buckets(df, [asc("v"), asc("id")], 30000, 6)
    sizes = [r["count"] for r in b.groupBy("_bucket").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1.6 * 30000 / 6
    g = global_prefix(df, [asc("v"), asc("id")], [], n_buckets=6)
    assert g.agg(F.max("row_no"), F.count_distinct("row_no")).first() == (30000, 30000)
