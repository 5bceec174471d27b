"""SQL access to the stored marts: each mart folder becomes a temporary view,
so dashboard queries can be written with ``spark.sql`` (partition filters on
``month_start`` / ``purchase_date`` still prune the scans)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillroll.plans.marts import MART_ORDER, PRESENCE, _exists
from tillroll.sources.sales_table import read_sales


def register_views(spark: SparkSession, marts_out: str, sales_path: str | None = None,
                   prefix: str = "") -> list[str]:
    """Create or replace temp views ``<prefix><mart>``, ``<prefix>daily_presence`` (and ``<prefix>sales``)."""
    names = []
    for name in [*MART_ORDER, PRESENCE]:
        path = f"{marts_out.rstrip('/')}/{name}"
        if _exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
    if sales_path:
        read_sales(spark, sales_path).createOrReplaceTempView(prefix + "sales")
        names.append(prefix + "sales")
    return names
