"""Dashboard queries: period KPIs, dynamics, client activity, breakdowns, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.classes import class_ordinal
from tillroll.functions.numeric import avg_half_up, cents, ratio_half_up
from tillroll.plans.marts import D20, distinct_in

GRAINS = {"day": None, "week": "week", "month": "month", "quarter": "quarter", "year": "year"}


def in_period(df: DataFrame, start, end, col: str = "purchase_date") -> DataFrame:
    """Inclusive period filter; a plain range so it prunes date partitions."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def kpis(daily: DataFrame, presence: DataFrame, start, end) -> DataFrame:
    """Revenue, units, sales, distinct clients and average sale of a period, from the daily mart.

    Distinct clients are merged from the days' id sets (a sum of daily distinct counts would count a
    returning client once per day); no sales are read."""
    g = in_period(daily, start, end).agg(
        F.sum("revenue").alias("_rev"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.coalesce(F.sum("sales_count"), F.lit(0)).cast("bigint").alias("sales_count"),
    )
    clients = distinct_in(in_period(presence, start, end), "client", out="unique_clients")
    return g.crossJoin(F.broadcast(clients)).select(
        F.lit(start).cast("date").alias("period_start"), F.lit(end).cast("date").alias("period_end"),
        F.coalesce(F.col("_rev"), F.lit(0)).cast(D20).alias("revenue"),
        F.coalesce(F.col("units_sold"), F.lit(0)).alias("units_sold"), "sales_count", "unique_clients",
        avg_half_up(cents(F.col("_rev")), F.col("sales_count"), 2, 2).alias("avg_sale_amount"),
    )


def _period(col: str, grain: str):
    unit = GRAINS[grain]
    c = F.col(col)
    return c if unit is None else F.date_trunc(unit, c).cast("date")


def sales_dynamics(daily: DataFrame, grain: str = "month", start=None, end=None) -> DataFrame:
    """Revenue and sales series rolled up from the daily mart, of a period where one is given."""
    g = (daily if start is None else in_period(daily, start, end)).groupBy(_period("purchase_date", grain).alias("period_start")).agg(
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.sum("revenue").cast(D20).alias("revenue"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
    )
    return g.withColumn("avg_sale_amount", avg_half_up(cents(F.col("revenue")), F.col("sales_count"), 2, 2))


def client_activity(daily: DataFrame, presence: DataFrame, grain: str = "month", start=None, end=None) -> DataFrame:
    """Active clients per period, with purchases per active client, from the daily mart and the days' id sets; of a
    period where one is given."""
    if start is not None:
        daily, presence = in_period(daily, start, end), in_period(presence, start, end)
    period = _period("purchase_date", grain)
    active = distinct_in(presence, "client", period, "active_clients")
    g = daily.groupBy(period.alias("period_start")).agg(
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("revenue").cast(D20).alias("revenue"),
    ).join(active, "period_start").select("period_start", "active_clients", "sales_count", "revenue")
    return g.withColumns({
        "sales_per_client": ratio_half_up(F.col("sales_count"), F.col("active_clients"), 4),
        "revenue_per_client": ratio_half_up(cents(F.col("revenue")), F.col("active_clients") * 100, 2),
    })


def segment_breakdown(rfm: DataFrame) -> DataFrame:
    """Clients and revenue per RFM segment with shares of the totals."""
    g = rfm.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum("monetary").cast(D20).alias("revenue"),
    )
    tot = g.agg(F.sum("clients").alias("_n"), F.sum("revenue").alias("_rev"))
    return g.crossJoin(F.broadcast(tot)).select(
        "rfm_segment", "clients", "revenue",
        ratio_half_up(F.col("clients"), F.col("_n"), 2, 100).alias("clients_pct"),
        ratio_half_up(cents(F.col("revenue")), cents(F.col("_rev")), 2, 100).alias("revenue_pct"),
    )


def class_breakdown(mart: DataFrame) -> DataFrame:
    """Products and revenue per ABC–XYZ class, in the fixed class order."""
    g = mart.groupBy("abc_xyz_class").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("revenue").cast(D20).alias("revenue"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
    )
    tot = g.agg(F.sum("products").alias("_n"), F.sum("revenue").alias("_rev"))
    return g.crossJoin(F.broadcast(tot)).select(
        "abc_xyz_class", class_ordinal(F.col("abc_xyz_class")).alias("class_order"),
        "products", "units_sold", "revenue",
        ratio_half_up(F.col("products"), F.col("_n"), 2, 100).alias("products_pct"),
        ratio_half_up(cents(F.col("revenue")), cents(F.col("_rev")), 2, 100).alias("revenue_pct"),
    ).orderBy("class_order")


def top_products(mart: DataFrame, k: int = 10) -> DataFrame:
    """The k products with the highest revenue (ties by product id).

    orderBy + limit plans as TakeOrderedAndProject: each partition keeps its
    own top k, only k rows per partition reach the final merge."""
    return (mart.select("product_id", "revenue", "units_sold", "sales_count", "abc_class",
                        "xyz_class", "abc_xyz_class")
            .orderBy(F.col("revenue").desc(), F.col("product_id").asc()).limit(k))
