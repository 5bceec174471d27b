"""Marts on hand-made sales: class borders, one month only, ties, returns."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillroll.plans import assortment, marts
from tillroll.sources.fixture import fixture_sales

COLS = ("sale_id long, client_id long, gender string, purchase_date date, purchase_time_seconds int, "
        "product_id long, quantity smallint, price_per_item decimal(14,2), discount_per_item decimal(14,2), "
        "total_price decimal(16,2)")


def sales(spark, rows):
    return spark.createDataFrame(
        [(i + 1, c, g, dt.date.fromisoformat(d), 100, p, q, D(pr), D(di), D(to))
         for i, (c, g, d, p, q, pr, di, to) in enumerate(rows)], COLS)


BORDER = [(1, "M", "2024-01-05", 1, 8, "10.00", "0.00", "80.00"),
          (2, "F", "2024-01-06", 2, 3, "5.00", "0.00", "15.00"),
          (3, "M", "2024-01-07", 3, 1, "5.00", "0.00", "5.00"),
          (1, "M", "2024-02-01", 1, 1, "0.00", "0.00", "0.00")]


def test_running_share_borders_mart_inclusive_study_strict(spark):
    s = sales(spark, BORDER)
    mart = {r.product_id: r for r in marts.product_abc_xyz(marts.product_monthly_sales(s)).collect()}
    assert [mart[p].cumulative_revenue_share for p in (1, 2, 3)] == [D("0.80000000"), D("0.95000000"), D("1.00000000")]
    assert [mart[p].abc_class for p in (1, 2, 3)] == ["A", "B", "C"]
    assert all(mart[p].total_months == 1 for p in (1, 2, 3))
    study = {r.product_id: r.abc_class for r in assortment.abc_profile(assortment.product_profile(s)).collect()}
    assert [study[p] for p in (1, 2, 3)] == ["A", "C", "C"]


def test_one_month_of_sales_gives_no_ranked_products(spark):
    s = sales(spark, BORDER[:3])
    assert marts.product_abc_xyz(marts.product_monthly_sales(s)).count() == 0
    assert marts.product_variability(marts.product_monthly_sales(s)).count() == 0


def test_equal_revenue_ties_break_on_product_id(spark):
    rows = [(1, "M", "2024-01-05", 9, 1, "10.00", "0.00", "10.00"),
            (1, "M", "2024-01-05", 4, 1, "10.00", "0.00", "10.00"),
            (1, "M", "2024-02-05", 4, 1, "0.00", "0.00", "0.00")]
    mart = {r.product_id: r for r in marts.product_abc_xyz(marts.product_monthly_sales(sales(spark, rows))).collect()}
    assert mart[4].cumulative_revenue_share == D("0.50000000")
    assert mart[9].cumulative_revenue_share == D("1.00000000")


def test_returns_zero_units_and_negative_revenue(spark):
    rows = [(1, "M", "2024-01-05", 1, 2, "10.00", "1.00", "18.00"),
            (1, "M", "2024-01-06", 1, -2, "10.00", "1.00", "-18.00"),
            (2, "F", "2024-01-07", 2, -1, "10.00", "0.00", "-10.00"),
            (2, "F", "2024-02-07", 2, 1, "0.00", "0.00", "0.00")]
    s = sales(spark, rows)
    mart = {r.product_id: r for r in marts.product_abc_xyz(marts.product_monthly_sales(s)).collect()}
    assert mart[1].units_sold == 0 and mart[1].revenue == D("0.00")
    assert mart[1].variation_coefficient is None and mart[1].xyz_class == "Z"
    assert mart[2].revenue == D("-10.00")
    daily = {str(r.purchase_date): r for r in marts.daily_sales(s).collect()}
    assert daily["2024-01-06"].revenue == D("-18.00")
    assert daily["2024-01-06"].weighted_discount_pct == D("10.00")


def test_mixed_gender_and_recency(spark):
    rows = [(1, "M", "2024-01-05", 1, 1, "1.00", "0.00", "1.00"),
            (1, "F", "2024-01-10", 1, 1, "1.00", "0.00", "1.00"),
            (2, "F", "2024-01-03", 1, 1, "1.00", "0.00", "1.00")]
    m = {r.client_id: r for r in marts.customer_metrics(sales(spark, rows)).collect()}
    assert m[1].gender == "Mixed" and m[2].gender == "F"
    assert m[1].recency_days == 0 and m[2].recency_days == 7


def test_invariants_on_fixture(spark):
    s = fixture_sales(spark, "/root/testdata/sf0.01")
    monthly = marts.product_monthly_sales(s)
    mart = marts.product_abc_xyz(monthly)
    total = s.agg(F.sum("total_price")).first()[0]
    assert marts.daily_sales(s).agg(F.sum("revenue")).first()[0] == total
    assert monthly.agg(F.sum("revenue")).first()[0] == total
    rows = mart.select("product_id", "revenue", "cumulative_revenue_share", "abc_class", "xyz_class").collect()
    rows.sort(key=lambda r: (-r.revenue, r.product_id))
    shares = [r.cumulative_revenue_share for r in rows]
    assert shares == sorted(shares) and shares[-1] == D("1.00000000")
    assert {r.abc_class for r in rows} == {"A", "B", "C"}
    xyz = {c: sum(1 for r in rows if r.xyz_class == c) for c in "XYZ"}
    n = len(rows)
    assert abs(xyz["X"] - n / 4) <= 1 and abs(xyz["Z"] - n / 4) <= 1
    rfm = marts.customer_rfm(s)
    assert rfm.count() == s.select("client_id").distinct().count()
    bounds = rfm.agg(*[F.min(c).alias(f"lo_{c}") for c in ("r_score", "f_score", "m_score")],
                     *[F.max(c).alias(f"hi_{c}") for c in ("r_score", "f_score", "m_score")]).first()
    assert min(bounds[:3]) >= 1 and max(bounds[3:]) <= 5
    assert rfm.where(F.col("rfm_segment").isNull()).count() == 0


def test_one_to_one_check(spark):
    import pytest
    from tillroll.plans.assortment import check_one_to_one
    ok = spark.createDataFrame([(1,), (2,)], "product_id long")
    check_one_to_one(ok)
    with pytest.raises(ValueError):
        check_one_to_one(ok.union(ok))
