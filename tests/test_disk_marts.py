"""Marts over many sales are built a run of months at a time."""

import os

from pyspark.sql import functions as F
from test_landing_bytes import _sales

from tillroll.plans import marts
from tillroll.session import checkpoint_dir
from tillroll.sources.sales_table import append_sales, date_versions, read_sales


def _staged_tables(spark):
    return set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))


def test_marts_are_built_in_runs_of_months(spark, scratch, monkeypatch):
    sales_path, names = f"{scratch}/sales", ["product_monthly_sales", "product_abc_xyz", "daily_sales"]
    sales = _sales(spark, 600).where("purchase_date is not null").withColumns({
        "purchase_date": F.add_months("purchase_date", (F.col("sale_id") % 3).cast("int")), "gender": F.lit("F"),
        "quantity": (F.col("sale_id") % 13 + 1).cast("smallint"), "loaded_at": F.current_timestamp()})
    append_sales(sales.where("purchase_date < '1996-04-01'"), sales_path)
    runs, real = [], marts.in_parts
    monkeypatch.setattr(marts, "in_parts", lambda *a: runs.append(real(*a)) or runs[-1])
    for at_once in (10 ** 7, 1):
        monkeypatch.setattr(marts, "ROWS_AT_ONCE", at_once)
        marts.refresh_marts(read_sales(spark, sales_path), f"{scratch}/marts-{at_once}", names, versions=date_versions(spark, sales_path))
    append_sales(sales.where("purchase_date >= '1996-04-01'"), sales_path)
    runs.clear()
    before = _staged_tables(spark)
    for at_once in (10 ** 7, 1):
        monkeypatch.setattr(marts, "ROWS_AT_ONCE", at_once)
        marts.refresh_marts(read_sales(spark, sales_path), f"{scratch}/marts-{at_once}", names, versions=date_versions(spark, sales_path))
    assert _staged_tables(spark) == before  # nothing staged is left
    assert {len(r) for r in runs} == {1, 2, 3}  # at once; new months; all months of the product mart
    sales, monthly = read_sales(spark, sales_path), marts.product_monthly_sales(read_sales(spark, sales_path))
    want = {"product_monthly_sales": monthly, "product_abc_xyz": marts.product_abc_xyz(monthly)}
    for name in names:
        one, many = [spark.read.parquet(f"{scratch}/marts-{n}/{name}") for n in (10 ** 7, 1)]
        rows = [sorted(map(str, df.select(*sorted(one.columns)).collect())) for df in (one, many, want.get(name, one))]
        assert rows[0] == rows[1] == rows[2] and rows[0], name


def test_product_sums_by_runs_with_nulls(spark, monkeypatch):
    month = lambda m: F.when(F.col(m) > 0, F.add_months(F.lit("2024-01-01").cast("date"), F.col(m)))
    monthly = spark.range(60).select(
        month("id").alias("x"), (F.col("id") % 7).cast("int").alias("m"), F.when(F.col("id") % 9 != 0, F.col("id") % 4).alias("product_id"),
        F.lit(1).alias("sales_count"), F.when(F.col("id") % 8 != 0, F.col("id")).alias("units_sold"),
        *[F.col("id").cast("decimal(20,2)").alias(c) for c in ("gross_revenue", "discount_amount", "revenue")])
    monthly = monthly.withColumn("month_start", month("m"))
    got = []
    for at_once in (10 ** 7, 1):
        monkeypatch.setattr(marts, "ROWS_AT_ONCE", at_once)
        got.append(sorted(map(str, marts._product_sums(monthly).collect())))
    assert got[0] == got[1] and len(got[0]) == 5
    by_moments = marts.product_variability(monthly).collect()
    assert {r.product_id: r.active_months for r in by_moments} == {r.product_id: r.active_months for r in marts._product_sums(monthly).collect()}
