"""Schemas and fixed values of the sales domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source application's) --------------------
# Field names of one sale in a landed day batch, in the order the API sends them.
REQUIRED_FIELDS = [
    "client_id", "gender", "purchase_datetime", "purchase_time_as_seconds_from_midnight",
    "product_id", "quantity", "price_per_item", "discount_per_item", "total_price",
]
# Nine ABC-XYZ classes in report order.
CLASS_ORDER = ["AX", "AY", "AZ", "BX", "BY", "BZ", "CX", "CY", "CZ"]
# Thresholds.
ABC_A, ABC_B = 0.80, 0.95
XYZ_MART_X, XYZ_MART_Y = 0.25, 0.75
XYZ_CLASSIC_X, XYZ_CLASSIC_Y = 0.10, 0.25
PARETO_SHARES = [1, 5, 10, 20, 50]
DESCRIBE_PCTS = [0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
DESCRIBE_PCTS_SHORT = [0.10, 0.25, 0.50, 0.75, 0.90]
SECONDS_PER_DAY = 86400
HISTORY_START = "2022-01-01"
# --------------------------------------------------------------------------

SALES_SCHEMA = T.StructType([
    T.StructField("sale_id", T.LongType(), False),
    T.StructField("client_id", T.LongType(), False),
    T.StructField("gender", T.StringType(), False),
    T.StructField("purchase_date", T.DateType(), False),
    T.StructField("purchase_time_seconds", T.IntegerType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("quantity", T.ShortType(), False),
    T.StructField("price_per_item", T.DecimalType(14, 2), False),
    T.StructField("discount_per_item", T.DecimalType(14, 2), False),
    T.StructField("total_price", T.DecimalType(16, 2), False),
    T.StructField("loaded_at", T.TimestampType(), False),
])
