"""The write-side queries land, load and refresh every date of the fact."""

from conftest import SF0001
from pyspark.sql import functions as F

from tillroll.queries import all_queries
from tillroll.sources.fixture import fixture_sales


def test_every_date_is_ingested_but_those_with_bad_files(spark):
    day = F.dayofyear("purchase_date") % 50
    dates = fixture_sales(spark, SF0001).select("purchase_date", day.alias("day")).distinct().collect()
    got = {r.purchase_date for r in all_queries()["ingested_sales"](spark, SF0001).select("purchase_date").collect()}
    assert got == {r.purchase_date for r in dates if r.day not in (7, 17)}
    assert {7, 17, 27} <= {r.day for r in dates} and len(got) > 1000


def test_refreshed_marts_hold_every_date(spark):
    want = {r.purchase_date for r in fixture_sales(spark, SF0001).select("purchase_date").distinct().collect()}
    got = {r.purchase_date for r in all_queries()["refreshed_daily_sales"](spark, SF0001).select("purchase_date").collect()}
    assert got == want
