"""Invariants of the one-year studies on the sf0.01 fixture."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll.plans import assortment as A
from tillroll.plans import customers as C
from tillroll.sources.fixture import STUDY_ANALYSIS_DATE, STUDY_YEAR, fixture_sales


@pytest.fixture(scope="module")
def year(spark):
    return A.read_year(fixture_sales(spark, "/root/testdata/sf0.01"), STUDY_YEAR).checkpoint()


def test_abc_classes_partition_products_and_shares_sum(year):
    profile = A.product_profile(year)
    summary = {r.abc_class: r for r in A.abc_summary(A.abc_profile(profile)).collect()}
    assert sum(r.products for r in summary.values()) == profile.count()
    assert abs(sum(r.revenue_pct for r in summary.values()) - D(100)) <= D("0.000003")
    assert abs(sum(r.products_pct for r in summary.values()) - D(100)) <= D("0.000003")


def test_adaptive_xyz_quartiles(year):
    xyz = A.xyz_profile(year, STUDY_YEAR)
    counts = {r.xyz_class: r["count"] for r in xyz.groupBy("xyz_class").count().collect()}
    n = sum(counts.values())
    assert abs(counts["X"] / n - 0.25) < 0.01 and abs(counts["Z"] / n - 0.25) < 0.01
    # the classic 0.10 / 0.25 borders put (almost) everything in Z, as in the source study
    classic = {r.xyz_class_classic for r in xyz.select("xyz_class_classic").distinct().collect()}
    assert "Z" in classic


def test_matrix_and_summary_agree(year):
    profile = A.product_profile(year)
    p = A.abc_xyz_profile(A.abc_profile(profile), A.xyz_profile(year, STUDY_YEAR))
    summary = A.abc_xyz_summary(p)
    assert summary.agg(F.sum("products")).first()[0] == profile.count()
    matrix = A.abc_xyz_matrix(summary).collect()
    cells = [v for r in matrix for v in (r.X, r.Y, r.Z) if v is not None]
    assert abs(sum(cells) - D(100)) <= D("0.00001")


def test_every_client_one_segment_and_pareto_monotone(year):
    profile = C.client_profile(year, STUDY_ANALYSIS_DATE)
    rfm = C.rfm_study(profile)
    assert rfm.count() == profile.count()
    segs = {r.rfm_segment for r in rfm.select("rfm_segment").distinct().collect()}
    assert all(not s[0].isdigit() for s in segs)
    scores = rfm.agg(F.min("r_score"), F.max("r_score"), F.min("m_score"), F.max("m_score")).first()
    assert tuple(scores) == (1, 5, 1, 5)
    top = [r.revenue_pct for r in C.pareto_summary(profile).orderBy("top_clients_pct").collect()]
    assert top == sorted(top) and top[-1] < D(100)
    freq = C.frequency_profile(profile).agg(F.sum("clients_pct")).first()[0]
    assert abs(freq - D(100)) <= D("0.0001")


def test_day_and_month_bits_match_distinct_counts(year):
    a = A.product_profile(year).select("product_id", "active_days", "active_months", "sales_count")
    b = year.groupBy("product_id").agg(F.count_distinct("purchase_date").alias("d"), F.count_distinct(F.month("purchase_date")).alias("m"),
                                       F.count_distinct("sale_id").alias("n"))
    assert a.join(b, "product_id").where("active_days <> d or active_months <> m or sales_count <> n").count() == 0
