"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the driver's tables (through the derived ``sales`` fact),
so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans import assortment as A
from tillroll.plans import coverage, dashboard, marts
from tillroll.plans import customers as C
from tillroll.session import checkpoint_dir, freed_shuffles, scratch, staged
from tillroll.functions.dates import day_series
from tillroll.plans import ingest
from tillroll.sources.batches import FLAGS, read_day_batches, validate_batches
from tillroll.sources.fixture import (LOADED_BEFORE, STUDY_ANALYSIS_DATE, STUDY_YEAR, dealt_sales, derived_sales, fixture_records,
                                      fixture_rows, fixture_sales, land_fixture_records, land_sales, sales_in_parts, with_bad_numbers)
from tillroll.sources.sales_table import date_versions, existing_dates, read_quarantine, read_sales

PERIOD = (f"{STUDY_YEAR}-01-01", f"{STUDY_YEAR}-12-31")

Query = Callable[[SparkSession, str], DataFrame]


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return fixture_sales(spark, sf_dir)


def _monthly(s, d):
    """The product-month mart, written once: its users read it twice."""
    return staged(marts.product_monthly_sales(_sales(s, d)), "monthly")


def _mart_queries() -> dict[str, Query]:
    return {
        "daily_sales": lambda s, d: marts.daily_sales(_sales(s, d)),
        "product_monthly_sales": lambda s, d: marts.product_monthly_sales(_sales(s, d)),
        "customer_metrics": lambda s, d: marts.customer_metrics(_sales(s, d)),
        "product_totals": lambda s, d: marts.product_totals(marts.product_monthly_sales(_sales(s, d))),
        "product_variability": lambda s, d: marts.product_variability(_monthly(s, d)),
        "customer_rfm": lambda s, d: marts.customer_rfm(_sales(s, d)),
        "product_abc_xyz": lambda s, d: marts.product_abc_xyz(_monthly(s, d)),
    }


def _coverage_queries() -> dict[str, Query]:
    return {
        "load_overview": lambda s, d: coverage.load_overview(_sales(s, d)),
        "rows_per_day": lambda s, d: coverage.rows_per_day(_sales(s, d)),
        "missing_dates": lambda s, d: coverage.missing_dates(_sales(s, d)),
    }


def _dashboard_queries() -> dict[str, Query]:
    def abc(s, d):
        return marts.product_abc_xyz(_monthly(s, d))

    def days(s, d):
        """The daily mart and the days' id sets, as they are stored."""
        sales = _sales(s, d)
        presence = staged(marts.daily_presence(sales), "presence")
        return staged(marts.daily_sales(sales, presence), "daily"), presence
    return {
        "kpis": lambda s, d: dashboard.kpis(*days(s, d), *PERIOD),
        "sales_dynamics": lambda s, d: dashboard.sales_dynamics(marts.daily_sales(_sales(s, d)), "month"),
        "client_activity": lambda s, d: dashboard.client_activity(*days(s, d), "month"),
        "daily_dynamics": lambda s, d: dashboard.sales_dynamics(marts.daily_sales(_sales(s, d)), "day", *PERIOD),
        "daily_activity": lambda s, d: dashboard.client_activity(*days(s, d), "day", *PERIOD),
        "segment_breakdown": lambda s, d: dashboard.segment_breakdown(marts.customer_rfm(_sales(s, d))),
        "class_breakdown": lambda s, d: dashboard.class_breakdown(abc(s, d)),
        "top_products": lambda s, d: dashboard.top_products(abc(s, d), 10),
    }


def _year(s, d):
    """The study year's sales, written once: a study reads them several times."""
    return staged(A.read_year(_sales(s, d), STUDY_YEAR), "year")


def _profile(s, d):
    return A.product_profile(A.read_year(_sales(s, d), STUDY_YEAR))


def _staged_profile(s, d):
    return staged(_profile(s, d), "profile")


def _xyz(s, d):
    return A.xyz_profile(A.read_year(_sales(s, d), STUDY_YEAR), STUDY_YEAR)


def _abc_xyz_of(year):
    return A.abc_xyz_profile(A.abc_profile(A.product_profile(year)), A.xyz_profile(year, STUDY_YEAR))


def _abc_xyz(s, d):
    return staged(_abc_xyz_of(_year(s, d)), "abc-xyz")


def _response(s, d):
    year = _year(s, d)
    return staged(A.discount_response(A.product_month_discount(year), _abc_xyz_of(year)), "response")


def _clients(s, d):
    return C.client_profile(A.read_year(_sales(s, d), STUDY_YEAR), STUDY_ANALYSIS_DATE)


def _study_queries() -> dict[str, Query]:
    def rfm(s, d):
        return C.rfm_study(_clients(s, d))
    return {
        "product_profile": _profile,
        "assortment_summary": lambda s, d: A.assortment_summary(_staged_profile(s, d)),
        "describe_products": lambda s, d: A.describe_products(_profile(s, d)),
        "abc_profile": lambda s, d: A.abc_profile(_profile(s, d)),
        "abc_summary": lambda s, d: A.abc_summary(A.abc_profile(_profile(s, d))),
        "monthly_demand_pivot": lambda s, d: A.monthly_demand_pivot(A.read_year(_sales(s, d), STUDY_YEAR), STUDY_YEAR),
        "xyz_profile": _xyz,
        "xyz_classic_counts": lambda s, d: A.xyz_classic_counts(_xyz(s, d)),
        "xyz_summary": lambda s, d: A.xyz_summary(_xyz(s, d)),
        "cv_histogram": lambda s, d: A.cv_histogram(_xyz(s, d)),
        "describe_cv": lambda s, d: A.describe_cv(_xyz(s, d)),
        "abc_xyz_profile": lambda s, d: _abc_xyz_of(_year(s, d)),
        "abc_xyz_summary": lambda s, d: A.abc_xyz_summary(_abc_xyz(s, d)),
        "abc_xyz_matrix": lambda s, d: A.abc_xyz_matrix(A.abc_xyz_summary(_abc_xyz(s, d))),
        "product_month_discount": lambda s, d: A.product_month_discount(A.read_year(_sales(s, d), STUDY_YEAR)),
        "discount_response": _response,
        "discount_summary": lambda s, d: A.discount_summary(_response(s, d)),
        "discount_means": lambda s, d: A.discount_means(_response(s, d)),
        "describe_uplift": lambda s, d: A.describe_uplift(_response(s, d)),
        "client_profile": _clients,
        "client_checks": lambda s, d: C.client_checks(_clients(s, d)),
        "describe_clients": lambda s, d: C.describe_clients(_clients(s, d)),
        "frequency_profile": lambda s, d: C.frequency_profile(_clients(s, d)),
        "client_pareto": lambda s, d: C.client_pareto(_clients(s, d)),
        "pareto_summary": lambda s, d: C.pareto_summary(_clients(s, d)),
        "rfm_study": rfm,
        "rfm_profile": lambda s, d: C.rfm_profile(rfm(s, d)),
    }


def _validated(s, d, sales=None):
    return validate_batches(fixture_records(s, d, sales), materialize=True)


def _folder(s, tag):
    return f"{checkpoint_dir(s).rstrip('/')}/{tag}-{uuid.uuid4().hex[:8]}"


def _landed_verdicts(s, d):
    """S-01 end to end: land the derived records as JSON-array files in the
    session's checkpoint folder, read them back, verdict per date."""
    root = _folder(s, "landing")
    land_fixture_records(fixture_records(s, d, dealt_sales(_sales(s, d))), root)
    records, files = read_day_batches(s, root)
    return validate_batches(records, files)[2]


def _ingest_status(s, d):
    sales = staged(_sales(s, d), "sales")
    bounds = sales.agg(F.min("purchase_date").alias("a"), F.max("purchase_date").alias("b"))
    requested = bounds.select(F.explode(day_series(F.col("a"), F.col("b"))).alias("batch_date"))
    loaded = existing_dates(sales.where(F.col("purchase_date") < F.lit(LOADED_BEFORE).cast("date")))
    status = ingest.plan_ingest(requested, loaded, _validated(s, d, sales)[2])
    return staged(status.select("batch_date", "status", "rows", "reason"), "status")


def _dates(rows):
    """The dates of the fixture's sales, in order: calendar days."""
    with freed_shuffles(rows.sparkSession):
        days = derived_sales(rows).select("purchase_date").distinct().orderBy("purchase_date")
        return [r.purchase_date for r in days.collect()]


def _ingested(s, d):
    """Land, ingest in two runs (the second with late files), read back: the records of even sale ids
    land first, the others later, so every date is loaded and then loaded again whole.  Some dates have
    odd files too: those with a cut or non-list file must not be loaded, those with multi-line files must."""
    rows, root, sales_path = fixture_rows(s, d), _folder(s, "landing"), _folder(s, "sales")
    dates = _dates(rows)
    for only, append in (("sale_id % 2 = 0", False), ("sale_id % 2 <> 0", True)):
        with scratch(s):
            land_sales(sales_in_parts(rows, F.expr(only)), root, odd_files=True, append=append)
        ingest.ingest_dates(s, root, sales_path, dates)
    return sales_path, dates


def _ingested_sales(s, d):
    """S-03, S-05, S-07: the loaded columns, and per date that ids are distinct and consecutive."""
    sales_path, _ = _ingested(s, d)
    return _loaded_totals(read_sales(s, sales_path))


def _loaded_totals(sales):
    """Distinct ids are the bits of words of 64 ids.  Loaded ids follow one another, so a shuffle of words has about a
    sixty-fourth of the rows that one of ids has."""
    bit = F.expr("shiftleft(1L, CAST(sale_id & 63 AS INT))")
    by_word = sales.groupBy("purchase_date", F.shiftright("sale_id", 6).alias("word")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits"), F.min("sale_id").alias("first"), F.max("sale_id").alias("last"),
        *[F.sum(c).alias(c) for c in ("quantity", "client_id", "product_id", "total_price")])
    return by_word.groupBy("purchase_date").agg(
        F.sum("n").alias("rows"), F.sum(F.bit_count("bits")).alias("ids"), (F.max("last") - F.min("first") + 1).alias("id_range"),
        F.sum("quantity").cast("bigint").alias("units"), F.sum("client_id").cast("bigint").alias("client_sum"),
        F.sum("product_id").cast("bigint").alias("product_sum"), F.sum("total_price").cast("decimal(20,2)").alias("revenue"))


def _refreshed(name):
    def query(s, d):
        """S-06, Q-13: marts built after one date, refreshed after a load of many, then a date that is replaced by a
        late file and a daily run."""
        rows, root = fixture_rows(s, d), _folder(s, "landing")
        sales_path, out = _folder(s, "sales"), _folder(s, "marts")
        dates = _dates(rows)
        late_date = dates[len(dates) // 2]
        late = (F.col("purchase_date") == F.lit(late_date)) & (F.col("sale_id") % 2 == 0)
        with scratch(s):
            land_sales(sales_in_parts(rows, ~late), root)
        ingest.ingest_dates(s, root, sales_path, dates[1:2])
        marts.refresh_marts(read_sales(s, sales_path), out, [name], versions=date_versions(s, sales_path))
        ingest.ingest_dates(s, root, sales_path, dates[:-1])
        marts.refresh_marts(read_sales(s, sales_path), out, [name], versions=date_versions(s, sales_path))
        with scratch(s):
            land_sales(sales_in_parts(rows, late), root, append=True)  # a file that lands late replaces its date
        ingest.ingest_dates(s, root, sales_path, [late_date])
        ingest.daily_load(s, root, sales_path, dates[-1] + dt.timedelta(days=1), out, names=[name])
        got = s.read.parquet(f"{out}/{name}")
        return got.drop("month_start") if name == "daily_sales" else got
    return query


def _quarantine_table(s, d):
    """Q-08..Q-10 as a table: records with defects of every kind, non-numeric values among them, land with odd files and
    are ingested; then even days of the year land again without defects, and their letters must be gone."""
    rows, root, sales_path = fixture_rows(s, d), _folder(s, "landing"), _folder(s, "sales")
    dates = _dates(rows)
    with scratch(s):
        parts = sales_in_parts(rows)
        land_sales(parts, root, lambda sales: with_bad_numbers(fixture_records(s, d, sales)), odd_files=True)
        ingest.ingest_dates(s, root, sales_path, dates)
        land_sales(parts, root, only=F.dayofyear("purchase_date") % 2 == 0, dates_only=True)
    ingest.ingest_dates(s, root, sales_path, dates)
    letters = read_quarantine(s, sales_path)
    kept = F.col("record").isNotNull()
    return letters.groupBy("batch_date", "reason").agg(
        F.count_if(kept).alias("records"), F.count_if(~kept).cast("int").alias("odd_files"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS],
        F.coalesce(F.sum(F.get_json_object("record", "$.product_id").cast("bigint")), F.lit(0)).alias("product_sum"))


def _key_contract(s, d):
    sales = staged(_sales(s, d), "sales")
    monthly = staged(marts.product_monthly_sales(sales), "monthly")
    specs = [("daily_sales", marts.daily_sales(sales), ["purchase_date"]),
             ("product_monthly_sales", monthly, ["month_start", "product_id"]),
             ("customer_rfm", marts.customer_rfm(sales), ["client_id"]),
             ("product_abc_xyz", marts.product_abc_xyz(monthly), ["product_id"])]
    out = None
    for name, df, keys in specs:
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        row = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"))
        row = row.select(F.lit(name).alias("mart"), "rows", "duplicate_keys")
        out = row if out is None else out.unionByName(row)
    return out


def _ingest_queries() -> dict[str, Query]:
    return {
        "validate_batches": lambda s, d: _validated(s, d)[2],
        "landed_verdicts": _landed_verdicts,
        "quarantine": lambda s, d: _validated(s, d)[1],
        "ingest_status": _ingest_status,
        "backfill_summary": lambda s, d: ingest.run_summary(_ingest_status(s, d)),
        "existing_dates": lambda s, d: existing_dates(_sales(s, d)),
        "key_contract": _key_contract,
        "ingested_sales": _ingested_sales,
        "quarantine_table": _quarantine_table,
        **{f"refreshed_{name}": _refreshed(name) for name in marts.MART_ORDER},
    }


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Registry boundary: exact DECIMAL results are handed over as DOUBLE (the
    same conversion on both sides of the oracle check), so value comparison
    does not depend on how each engine exposes decimals."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _boundary(fn: Query) -> Query:
    return lambda s, d: decimals_to_double(fn(s, d))


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_mart_queries())
    out.update(_coverage_queries())
    out.update(_dashboard_queries())
    out.update(_study_queries())
    out.update(_ingest_queries())
    return {k: _boundary(v) for k, v in out.items()}
