"""Exact rounding helpers against Python Decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal, getcontext

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.functions.numeric import ratio_half_up, sqrt_half_up
from tillroll.operators.ranks import quantile_score

getcontext().prec = 60


def half_up(x: Decimal, scale: int) -> Decimal:
    q = Decimal(1).scaleb(-scale)
    return x.copy_abs().quantize(q, rounding=ROUND_HALF_UP) * (1 if x >= 0 else -1)


def test_ratio_half_up_matches_decimal(spark):
    pairs = [(1, 8), (5, 2), (-5, 2), (201, 200), (-201, 200), (1, 3), (2, 3), (7, -9), (0, 5), (3, 0),
             (123456789, 1000), (10 ** 12 + 1, 7)]
    df = spark.createDataFrame(pairs, "n long, d long")
    out = df.select("n", "d", ratio_half_up(F.col("n"), F.col("d"), 2).alias("r2"),
                    ratio_half_up(F.col("n"), F.col("d"), 4, mult=100).alias("p4")).collect()
    for r in out:
        if r.d == 0:
            assert r.r2 is None and r.p4 is None
            continue
        assert r.r2 == half_up(Decimal(r.n) / Decimal(r.d), 2), r
        assert r.p4 == half_up(Decimal(100 * r.n) / Decimal(r.d), 4), r


def test_half_cent_average_is_rounded_once(spark):
    # 2.01 / 2 = 1.005 -> 1.01 (a double or decimal(.,6) step would give 1.00 or round twice)
    df = spark.createDataFrame([(201, 200)], "n long, d long")
    assert df.select(ratio_half_up(F.col("n"), F.col("d"), 2).alias("x")).first().x == Decimal("1.01")


def test_sqrt_half_up_matches_decimal(spark):
    pairs = [(1, 64), (2, 1), (0, 5), (10 ** 12 + 3, 7), (15625, 1000000), (99, 100), (1, 3)]
    df = spark.createDataFrame(pairs, "n long, d long")
    out = df.select("n", "d", sqrt_half_up(F.col("n"), F.col("d"), 2).alias("s")).collect()
    for r in out:
        exact = (Decimal(r.n) / Decimal(r.d)).sqrt()
        assert r.s == half_up(exact, 2), r


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 11, 13, 100, 398])
def test_quantile_score_equals_qcut_of_rank_first(spark, n):
    values = [(i, (i * 7919) % 13) for i in range(n)]
    pdf = pd.DataFrame(values, columns=["id", "v"])
    if n > 1:
        expected = pd.qcut(pdf["v"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    else:
        expected = [1]
    ranks = pdf["v"].rank(method="first").astype(int).tolist()
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ranks)], "id long, rk long")
    got = {r.id: r.s for r in df.select("id", quantile_score(F.col("rk"), F.lit(n)).alias("s")).collect()}
    assert [got[i] for i in range(n)] == expected
