"""The ``sales`` fact derived from the driver's test tables.

The test tables have no sales fact, so one is derived from lineitem ⋈ orders
with whole-cent arithmetic (the same text runs in Spark SQL and DuckDB, see
FIXTURES.md §2).  Only the seven needed lineitem columns and three orders
columns are read, so the scan prunes the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ROWS_AT_ONCE, freed_shuffles, in_parts, staged

# --- fixed values: the derivation rules of the test fact -------------------
_INNER = [
    ("sale_id", "((l_orderkey*8 + l_linenumber)*20001 + l_partkey)*1001 + l_suppkey"),
    ("client_id", "o_custkey"),
    ("gender", "CASE WHEN (o_custkey + CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END) % 2 = 0 "
               "THEN 'M' ELSE 'F' END"),
    ("purchase_date", "CAST(o_orderdate AS DATE)"),
    ("purchase_time_seconds", "CAST((l_orderkey*7919 + l_linenumber*104729) % 86400 AS INT)"),
    ("product_id", "l_partkey"),
    ("quantity", "CAST(l_quantity AS SMALLINT)"),
    ("price_cents", "CAST(ROUND(l_extendedprice*100/l_quantity, 0) AS BIGINT)"),
    ("disc_cents", "CAST(FLOOR(ROUND(l_extendedprice*100/l_quantity, 0) * ROUND(l_discount*100, 0) / 100) AS BIGINT)"),
]
_OUTER = [
    ("price_per_item", "CAST(CAST(price_cents AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2))"),
    ("discount_per_item", "CAST(CAST(disc_cents AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2))"),
    ("total_price", "CAST(CAST(quantity * (price_cents - disc_cents) AS DECIMAL(16,0)) "
                    "* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(16,2))"),
]
STUDY_YEAR = 1998
STUDY_ANALYSIS_DATE = "1999-01-01"
# --------------------------------------------------------------------------

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount"]
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of lineitem and orders that sales are derived from."""
    li = table(spark, sf_dir, "lineitem").select(*_LINEITEM_COLS)
    od = table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    return li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))


def derived_sales(rows: DataFrame, *beside: str) -> DataFrame:
    """The sales of ``fixture_rows``, with the columns ``beside`` of these rows."""
    inner = rows.select(*[F.expr(e).alias(n) for n, e in _INNER], *beside)
    keep = ["sale_id", "client_id", "gender", "purchase_date", "purchase_time_seconds",
            "product_id", "quantity"]
    return inner.select(*keep, *[F.expr(e).alias(n) for n, e in _OUTER], *beside)


def fixture_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows (without ``loaded_at``) derived from lineitem and orders."""
    return derived_sales(fixture_rows(spark, sf_dir))


# --- fixed values: defects injected into the derived API records ------------
# (every rule is a property of the row, so the expected verdicts are plain SQL)
MISSING_GENDER_DAY_OF_YEAR = 100      # the whole date lacks the gender field
BAD_DATETIME_MOD = 5003               # unparseable purchase_datetime
NEXT_DAY_MOD = 3001                   # purchase_datetime on the following day
BAD_TIME_MOD = 2003                   # time of day 86400
BAD_QUANTITY_MOD = 7001               # quantity 40000 (outside SMALLINT)
BAD_TOTAL_MOD = 1009                  # total_price off by 0.01
BAD_NUMBER_MOD = 4001                 # quantity that is no number (``with_bad_numbers`` only)
LOADED_BEFORE = "1996-01-01"          # dates before this are already in the table
ODD_FILE_DAYS = 50                    # days of the year, modulo this, whose landed files are odd:
CUT_FILE_DAY, NON_LIST_DAY, MULTI_LINE_DAY = 7, 17, 27  # a further cut file, a further non-list file, arrays over many lines
# ---------------------------------------------------------------------------


def _hms(t):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(t / 3600)), two(F.floor(t % 3600 / 60)), two(t % 60))


def fixture_records(spark: SparkSession, sf_dir: str, sales: DataFrame | None = None) -> DataFrame:
    """The fixture sales as landed API records (batch_date, file, pos, rec
    map<string,string>) with rule-based defects; every sale becomes a record."""
    s = fixture_sales(spark, sf_dir) if sales is None else sales
    sid = F.col("sale_id")
    day = F.col("purchase_date")
    shown_day = (F.when(sid % NEXT_DAY_MOD == 0, F.date_add(day, 1)).otherwise(day)).cast("string")
    dt_text = F.when(sid % BAD_DATETIME_MOD == 0, F.lit("not-a-date")) \
        .otherwise(F.concat_ws(" ", shown_day, _hms(F.col("purchase_time_seconds"))))
    t = F.when(sid % BAD_TIME_MOD == 0, F.lit(86400)).otherwise(F.col("purchase_time_seconds"))
    qty = F.when(sid % BAD_QUANTITY_MOD == 0, F.lit(40000)).otherwise(F.col("quantity"))
    total = F.when(sid % BAD_TOTAL_MOD == 0, F.col("total_price") + F.lit(0.01).cast("decimal(3,2)")) \
        .otherwise(F.col("total_price")).cast("decimal(16,2)")
    pairs = [
        ("client_id", F.col("client_id")), ("gender", F.col("gender")), ("purchase_datetime", dt_text),
        ("purchase_time_as_seconds_from_midnight", t), ("product_id", F.col("product_id")),
        ("quantity", qty), ("price_per_item", F.col("price_per_item")),
        ("discount_per_item", F.col("discount_per_item")), ("total_price", total),
    ]
    rec = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))])
    no_gender = F.dayofyear(day) == MISSING_GENDER_DAY_OF_YEAR
    rec = F.when(no_gender, F.map_filter(rec, lambda k, v: k != F.lit("gender"))).otherwise(rec)
    return s.select(day.alias("batch_date"), F.lit("derived").alias("file"),
                    sid.alias("pos"), rec.alias("rec"), *[c for c in s.columns if c == "_chunk"])


def with_bad_numbers(records: DataFrame) -> DataFrame:
    """Some quantities as text that is no number."""
    wrong = F.map_concat(F.map_filter("rec", lambda k, v: k != F.lit("quantity")), F.create_map(F.lit("quantity"), F.lit("n/a")))
    return records.withColumn("rec", F.when(F.col("pos") % BAD_NUMBER_MOD == 0, wrong).otherwise(F.col("rec")))


def plain_records(sales: DataFrame) -> DataFrame:
    """Sales as API records without defects."""
    pairs = [("client_id", F.col("client_id")), ("gender", F.col("gender")),
             ("purchase_datetime", F.concat_ws(" ", F.col("purchase_date").cast("string"), _hms(F.col("purchase_time_seconds")))),
             ("purchase_time_as_seconds_from_midnight", F.col("purchase_time_seconds")), ("product_id", F.col("product_id")),
             ("quantity", F.col("quantity")), ("price_per_item", F.col("price_per_item")),
             ("discount_per_item", F.col("discount_per_item")), ("total_price", F.col("total_price"))]
    rec = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))])
    return sales.select(F.col("purchase_date").alias("batch_date"), F.lit("plain").alias("file"), F.col("sale_id").alias("pos"), rec.alias("rec"),
                        *[c for c in sales.columns if c == "_chunk"])


RECORDS_PER_FILE = 5000


def _arrays_per_day(rows: DataFrame, day: str) -> DataFrame:
    """The number of arrays of each date; a row a calendar day."""
    return rows.groupBy(day).agg(F.ceil(F.count(F.lit(1)) / F.lit(RECORDS_PER_FILE)).cast("int").alias("_k"))


def _dealt(rows: DataFrame, per_day: DataFrame, day: str, pos: str) -> DataFrame:
    """``rows`` with their array (``_chunk``), each array's rows in one task."""
    from tillroll.sources.sales_table import write_tasks
    chunked = rows.join(F.broadcast(per_day), day).withColumn("_chunk", F.pmod(F.xxhash64(pos), F.col("_k"))).drop("_k")
    return chunked.repartition(write_tasks(rows.sparkSession), day, "_chunk")


def dealt_sales(sales: DataFrame) -> DataFrame:
    """Sales dealt to the arrays that their records land in.  Typed columns travel in a third of the bytes that
    records of text take; ``sales`` is computed twice, first for its dates only."""
    return _dealt(sales, _arrays_per_day(sales, "purchase_date"), "purchase_date", "sale_id")


def sales_in_parts(rows: DataFrame, only: Column | None = None) -> list[tuple[list, DataFrame]]:
    """The sales of ``fixture_rows`` for which ``only`` holds, as (dates, sales) of runs of dates.  Of more than
    ROWS_AT_ONCE the rows, which take half of their sales' bytes, are staged by run, so that each sale is read with its
    run alone; sales without a date are in none."""
    columns, spark = rows.columns, rows.sparkSession
    full = derived_sales(rows, *columns).where(F.lit(True) if only is None else only)
    with freed_shuffles(spark):
        counted = full.where("purchase_date is not null").groupBy("purchase_date").agg(F.count(F.lit(1)).alias("n")).collect()
    runs = in_parts({r.purchase_date: r.n for r in counted}, ROWS_AT_ONCE)  # calendar days
    if len(runs) < 2:
        return [(sum(runs, []), full.drop(*columns))]
    run_of = spark.createDataFrame([(d, i) for i, run in enumerate(runs) for d in run], "purchase_date date, _run int")
    by_run = staged(full.join(F.broadcast(run_of), "purchase_date").select(*columns, "_run"), "rows", by=("_run",))
    return [(run, derived_sales(by_run.where(F.col("_run") == i))) for i, run in enumerate(runs)]


def land_sales(parts: list[tuple[list, DataFrame]], root: str, records: Callable = plain_records, only: Column | None = None,
               odd_files: bool = False, append: bool = False, dates_only: bool = False) -> None:
    """Land ``sales_in_parts`` as the records that ``records`` makes of them, a run of dates at a time: what is shuffled is
    a run's.  ``only``: a condition on whole dates."""
    for i, (dates, sales) in enumerate(parts):
        some = sales if only is None else sales.where(only)
        land_fixture_records(records(dealt_sales(some)), root, "append" if append or i and not dates_only else "overwrite", odd_files,
                             dates_only, dates if only is None else None)


def land_fixture_records(records: DataFrame, root: str, mode: str = "overwrite", odd_files: bool = False,
                         dates_only: bool = False, dates: list | None = None) -> None:
    """Land API records as the source receives them: JSON arrays, one array per
    (gzipped) file under ``batch_date=...``.  A date is split into
    ceil(rows / RECORDS_PER_FILE) arrays by a hash of the record, so no array
    (one row, one task) grows with the data; records of ``dealt_sales`` are split already.  ``odd_files``: beside its
    good files a date of CUT_FILE_DAY gets one that ends early and one of NON_LIST_DAY one that is no list;
    MULTI_LINE_DAY's arrays take a line a record.  ``dates_only``: only the records' own dates are replaced.  ``dates``: the
    records' dates, where they are known."""
    dealt = records
    if "_chunk" not in records.columns:
        dealt = _dealt(records, _arrays_per_day(records, "batch_date"), "batch_date", "pos")
    arrays = dealt.groupBy("batch_date", "_chunk").agg(
        F.to_json(F.collect_list(F.col("rec"))).alias("value"))
    if odd_files:
        day = F.dayofyear("batch_date") % ODD_FILE_DAYS
        arrays = arrays.withColumn("value", F.when(day == MULTI_LINE_DAY, F.regexp_replace("value", r"\},\{", "},\n  {"))
                                   .otherwise(F.col("value")))
        body = F.when(day == CUT_FILE_DAY, '[{"client_id":"1","gender":').when(day == NON_LIST_DAY, '{"client_id":"1"}')
        days = records.select("batch_date").distinct() if dates is None else \
            records.sparkSession.createDataFrame([(d,) for d in dates], "batch_date date")
        arrays = arrays.unionByName(days.select("batch_date", F.lit(-1).alias("_chunk"), body.alias("value")).where("value is not null"))
    with freed_shuffles(records.sparkSession):
        (arrays.select("batch_date", "value")
         .write.mode(mode).option("partitionOverwriteMode", "dynamic" if dates_only else "static").option("maxRecordsPerFile", 1)
         .option("compression", "gzip").partitionBy("batch_date").text(root))
