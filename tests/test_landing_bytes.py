"""Landing deals typed sales, not records, and in one shuffle; files are gzipped."""

import glob

from pyspark.sql import functions as F

from tillroll.sources import fixture
from tillroll.sources.batches import read_day_batches, validate_batches


def _sales(spark, n):
    return spark.range(n).select(
        (F.col("id") + 1).alias("sale_id"), (F.col("id") % 7).alias("client_id"), F.lit("F").alias("gender"),
        F.when(F.col("id") % 50 != 0, F.date_add(F.lit("1996-03-01").cast("date"), (F.col("id") % 3).cast("int"))).alias("purchase_date"),
        (F.col("id") % 86400).cast("int").alias("purchase_time_seconds"), (F.col("id") % 11).alias("product_id"),
        F.lit(2).cast("smallint").alias("quantity"), *[F.lit(x).cast(f"decimal({p},2)").alias(c) for c, x, p in (
            ("price_per_item", "3.00", 14), ("discount_per_item", "1.00", 14), ("total_price", "4.00", 16))])


def test_dealt_sales_land_as_the_records_do(spark, scratch, monkeypatch):
    monkeypatch.setattr(fixture, "RECORDS_PER_FILE", 100)
    sales, got = _sales(spark, 1000), []
    for root, rows in ((f"{scratch}/a", sales), (f"{scratch}/b", fixture.dealt_sales(sales))):
        fixture.land_fixture_records(fixture.fixture_records(spark, "", rows), root)
        records, files = read_day_batches(spark, root)
        got.append((sorted(str(sorted(r.rec.items())) for r in records.collect()),
                    sorted(map(str, validate_batches(records, files)[2].collect()))))
        names = glob.glob(f"{root.removeprefix('file:')}/batch_date=*/part-*")
        assert len(names) > 3 and all(x.endswith(".gz") for x in names)
    assert got[0] == got[1] and len(got[0][0]) == 980  # every sale with a date


def test_dealt_records_are_not_shuffled_again(spark):
    records = fixture.fixture_records(spark, "", fixture.dealt_sales(_sales(spark, 1000)))
    plan = records.groupBy("batch_date", "_chunk").agg(F.collect_list("rec"))._jdf.queryExecution().executedPlan().toString()
    deals = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("_chunk" in x for x in deals) == 1 and not any("rec#" in x for x in deals)
