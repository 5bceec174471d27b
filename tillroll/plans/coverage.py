"""Load-coverage checks over the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import explode_days
from tillroll.session import staged
from tillroll.sources.sales_table import LOAD_LOG_SCHEMA, existing_dates, load_log_path, partition_dates, read_log, read_sales


def load_overview(sales: DataFrame) -> DataFrame:
    """min/max date, distinct days and rows (one row)."""
    return sales.agg(
        F.min("purchase_date").alias("min_date"),
        F.max("purchase_date").alias("max_date"),
        F.count_distinct("purchase_date").alias("loaded_days"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def logged_overview(spark: SparkSession, sales_path: str) -> DataFrame:
    """The same from the load log, whose counts were taken while the dates were written; no sales are read.  Where the
    log does not know every date of the table, the table is read."""
    there = partition_dates(spark, sales_path)
    last = read_log(spark, load_log_path(sales_path), LOAD_LOG_SCHEMA).groupBy("batch_date").agg(F.max_by("rows", "min_sale_id").alias("rows"))
    days = spark.createDataFrame([(d,) for d in sorted(there)], "batch_date date")  # calendar days
    known = staged(days.join(last, "batch_date", "left"), "days")
    if known.where("rows is null").limit(1).count():
        return load_overview(read_sales(spark, sales_path))
    return known.agg(F.min("batch_date").alias("min_date"), F.max("batch_date").alias("max_date"),
                     F.count(F.lit(1)).alias("loaded_days"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"))


def rows_per_day(sales: DataFrame) -> DataFrame:
    return (sales.groupBy("purchase_date").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy("purchase_date"))


def missing_dates(sales: DataFrame) -> DataFrame:
    """Calendar days between the first and last loaded day with no rows.  The fact is read once, for
    its dates."""
    have = staged(existing_dates(sales), "dates")
    bounds = have.agg(F.min("purchase_date").alias("lo"), F.max("purchase_date").alias("hi"))
    calendar = explode_days(bounds, "lo", "hi", "expected_date")
    return (calendar.join(have, calendar["expected_date"] == have["purchase_date"], "left_anti")
            .orderBy("expected_date"))
