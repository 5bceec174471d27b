"""The four derived tables of the sales fact and their refresh.

``daily_sales`` and ``product_monthly_sales`` are plain grouped aggregates
(partial aggregation map-side, one shuffle on the group key).  Distinct clients
and products of a day are bit sets that merge into any longer period, and client
totals are kept by month, so that a replaced date takes one month out and back in.
``customer_rfm`` and ``product_abc_xyz`` need whole-table ranks; those go
through ``operators.ranks`` so no step runs in a single task.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.classes import abc_class, rfm_segment_mart, xyz_class
from tillroll.functions.numeric import (INT, as_int, avg_half_up, cents, int_div,
                                        ratio_half_up, sqrt_half_up)
from tillroll.operators.ranks import asc, cume_counts_many, desc, global_prefix
from tillroll.schema import ABC_A, ABC_B, XYZ_MART_X, XYZ_MART_Y
from tillroll.session import CODEC, ROWS_AT_ONCE, freed_shuffles, in_parts, read_text, replace_text, scratch, staged, unstage

D20 = "decimal(20,2)"


def with_amounts(sales: DataFrame) -> DataFrame:
    """gross_revenue, discount_amount (DECIMAL(20,2)) and purchase_month."""
    return sales.withColumns({
        "gross_revenue": F.col("quantity") * F.col("price_per_item"),
        "discount_amount": F.col("quantity") * F.col("discount_per_item"),
        "purchase_month": F.trunc("purchase_date", "MM"),
    })


def pct_half_up(num: Column, den: Column, scale: int = 2, precision: int = 8) -> Column:
    """100 * num / den for two money columns, rounded once; NULL when den = 0."""
    return ratio_half_up(cents(num), cents(den), scale, mult=100, precision=precision)


def daily_presence(sales: DataFrame) -> DataFrame:
    """(purchase_date, kind, word, bits): the day's distinct clients and products (``kind``), exactly.

    Ids word * 64 .. word * 64 + 63 are the bits of one long.  Words merge by OR, in each task before the
    shuffle and again into weeks, months or any period, so a period's distinct count reads no sales."""
    seen = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_id").cast("bigint").alias("id")) for k in ("client", "product")]))
    ids = sales.select("purchase_date", seen.alias("s")).select("purchase_date", "s.kind", "s.id").where("id is not null")
    return ids.groupBy("purchase_date", "kind", F.shiftright("id", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(id & 63L as int))")).alias("bits"))


def distinct_in(presence: DataFrame, kind: str, period: Column | None = None, out: str = "n") -> DataFrame:
    """(period_start, out): distinct ids of a kind by period, or one row (out) over all the days."""
    by = [] if period is None else [period.alias("period_start")]
    names = [] if period is None else ["period_start"]
    merged = presence.where(F.col("kind") == kind).groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*names).agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias(out))


def daily_sales(sales: DataFrame, presence: DataFrame | None = None) -> DataFrame:
    """One row a date.  ``presence``: the dates' ``daily_presence``, where it is stored."""
    s = with_amounts(sales)
    g = s.groupBy("purchase_date").agg(
        F.count(F.lit(1)).alias("sales_count"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("gross_revenue").alias("_gross"),
        F.sum("discount_amount").alias("_disc"),
        F.sum("total_price").alias("_rev"),
    )
    ids = F.bit_count("bits")
    distinct = (daily_presence(sales) if presence is None else presence).groupBy("purchase_date").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "client", ids)), F.lit(0)).cast("bigint").alias("unique_clients"),
        F.coalesce(F.sum(F.when(F.col("kind") == "product", ids)), F.lit(0)).cast("bigint").alias("unique_products"))
    return g.join(distinct, "purchase_date", "left").select(
        "purchase_date", "sales_count", F.coalesce("unique_clients", F.lit(0)).alias("unique_clients"),
        F.coalesce("unique_products", F.lit(0)).alias("unique_products"), "units_sold",
        F.col("_gross").cast(D20).alias("gross_revenue"),
        F.col("_disc").cast(D20).alias("discount_amount"),
        F.col("_rev").cast(D20).alias("revenue"),
        avg_half_up(cents(F.col("_rev")), F.col("sales_count"), 2, 2).alias("avg_sale_amount"),
        pct_half_up(F.col("_disc"), F.col("_gross")).alias("weighted_discount_pct"),
    )


def product_monthly_sales(sales: DataFrame) -> DataFrame:
    s = with_amounts(sales)
    g = s.groupBy(F.col("purchase_month").alias("month_start"), "product_id").agg(
        F.count(F.lit(1)).cast("int").alias("sales_count"),
        F.count_distinct("client_id").cast("int").alias("unique_clients"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("total_price").cast(D20).alias("revenue"),
    )
    return g


def client_aggregates(sales: DataFrame, by: tuple = ()) -> DataFrame:
    """Mergeable per-client totals: gender min/max, first/last date, rows,
    distinct days, units, revenue.  Two loads of disjoint dates merge by
    min/max/sum (``merge_client_aggregates``)."""
    return sales.groupBy(*by, "client_id").agg(
        F.min("gender").alias("gender_min"),
        F.max("gender").alias("gender_max"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("purchase_date").alias("days"),
        F.sum("quantity").cast("bigint").alias("units"),
        F.sum("total_price").cast("decimal(38,2)").alias("revenue"),
    )


def client_months(sales: DataFrame) -> DataFrame:
    """The totals by client and month: a month can be taken out and built again, which totals with a minimum or a
    maximum can't do."""
    return client_aggregates(sales, (F.trunc("purchase_date", "MM").alias("month_start"),))


def totals_of_months(months: DataFrame) -> DataFrame:
    """A client's totals from the months' totals; no sales are read."""
    return months.groupBy("client_id").agg(
        F.min("gender_min").alias("gender_min"),
        F.max("gender_max").alias("gender_max"),
        F.min("first_purchase_date").alias("first_purchase_date"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("days").cast("bigint").alias("days"),  # months share no day
        F.sum("units").cast("bigint").alias("units"),
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
    )


def merge_client_aggregates(old: DataFrame, new: DataFrame) -> DataFrame:
    """Combine the totals of two sets of disjoint dates (one outer join on
    the client key; both sides are one row per client)."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col("o.client_id") == F.col("n.client_id"), "full")

    def both(c, fn):
        return fn(F.col(f"o.{c}"), F.col(f"n.{c}"))

    def add(c):
        return F.coalesce(F.col(f"o.{c}"), F.lit(0)) + F.coalesce(F.col(f"n.{c}"), F.lit(0))

    return j.select(
        F.coalesce(F.col("o.client_id"), F.col("n.client_id")).alias("client_id"),
        both("gender_min", F.least).alias("gender_min"),
        both("gender_max", F.greatest).alias("gender_max"),
        both("first_purchase_date", F.least).alias("first_purchase_date"),
        both("last_purchase_date", F.greatest).alias("last_purchase_date"),
        add("rows").cast("bigint").alias("rows"),
        add("days").cast("bigint").alias("days"),
        add("units").cast("bigint").alias("units"),
        add("revenue").cast("decimal(38,2)").alias("revenue"),
    )


def metrics_from_aggregates(agg: DataFrame, analysis_date=None) -> DataFrame:
    """customer_metrics columns from client totals; recency against the
    latest last date (a pass over the client table) or a given date."""
    if analysis_date is None:
        params = agg.agg(F.max("last_purchase_date").alias("analysis_date"))
    else:
        params = agg.sparkSession.range(1).select(F.lit(analysis_date).cast("date").alias("analysis_date"))
    g = agg.crossJoin(F.broadcast(params))
    return g.select(
        "client_id",
        F.when(F.col("gender_min") == F.col("gender_max"), F.col("gender_min")).otherwise(F.lit("Mixed"))
        .alias("gender"),
        "analysis_date", "first_purchase_date", "last_purchase_date",
        F.datediff("analysis_date", "last_purchase_date").cast("int").alias("recency_days"),
        F.col("rows").cast("int").alias("frequency"),
        F.col("days").cast("int").alias("active_days"),
        F.col("units").cast("bigint").alias("units_purchased"),
        F.col("revenue").cast(D20).alias("monetary"),
        avg_half_up(cents(F.col("revenue")), F.col("rows"), 2, 2).alias("avg_sale_amount"),
    )


def customer_metrics(sales: DataFrame, analysis_date=None, materialize: bool = True) -> DataFrame:
    """One row per client; recency against the latest sale date (or a given date).

    The client totals are staged once: the latest date is read from
    them, so the fact is scanned a single time (two branches of one aggregate
    with different column pruning would each scan it)."""
    agg = client_aggregates(sales)
    if materialize:
        agg = staged(agg, "clients")
    return metrics_from_aggregates(agg, analysis_date)


def _ceil_fifths(count_le: Column, n: Column) -> Column:
    """ceil(5 * count_le / n) in integers (= ceil(cume_dist * 5))."""
    return int_div(as_int(count_le) * 5 + as_int(n) - 1, as_int(n)).cast("smallint")


def customer_rfm(sales: DataFrame, n_buckets: int | None = None) -> DataFrame:
    return rfm_from_metrics(customer_metrics(sales), n_buckets)


def rfm_from_metrics(metrics: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Quintile scores by CUME_DIST of recency (reversed), frequency and
    monetary, the 3-digit code and the segment ladder."""
    n_clients = metrics.count()
    n = F.lit(n_clients)
    ranked = cume_counts_many(metrics, ["recency_days", "frequency", "monetary"], ["_le_r", "_le_f", "_le_m"],
                              n_clients, n_buckets)
    r = (F.lit(6) - _ceil_fifths(F.col("_le_r"), n)).cast("smallint")
    f = _ceil_fifths(F.col("_le_f"), n)
    m = _ceil_fifths(F.col("_le_m"), n)
    scored = ranked.withColumns({"r_score": r, "f_score": f, "m_score": m})
    return scored.select(
        "client_id", "gender", "analysis_date", "first_purchase_date", "last_purchase_date",
        "recency_days", "frequency", "active_days", "units_purchased", "monetary",
        "avg_sale_amount", "r_score", "f_score", "m_score",
        F.concat(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("rfm_code"),
        rfm_segment_mart(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("rfm_segment"),
    )


def product_totals(monthly: DataFrame) -> DataFrame:
    g = monthly.groupBy("product_id").agg(
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("revenue").cast(D20).alias("revenue"),
    )
    return g.withColumn("weighted_discount_pct", pct_half_up(F.col("discount_amount"), F.col("gross_revenue")))


def _month_bounds(monthly: DataFrame) -> DataFrame:
    """min month, last complete month (the month before the latest) and the
    number M of months in between (0 when there is only one month)."""
    b = monthly.agg(F.min("month_start").alias("_min_month"),
                    F.add_months(F.max("month_start"), -1).alias("_max_complete"))
    m = F.when(F.col("_max_complete") >= F.col("_min_month"),
               F.months_between("_max_complete", "_min_month").cast("int") + 1).otherwise(0)
    return b.withColumn("_n_months", m)


def _variability_moments(monthly: DataFrame) -> list[Column]:
    """Aggregates over product-months in the complete-month window: active
    months, sum and sum of squares of units (zero months add nothing)."""
    inside = F.col("month_start") <= F.col("_max_complete")
    units = F.col("units_sold").cast(INT)
    return [
        F.count(F.when(inside, F.lit(1))).cast("int").alias("active_months"),
        F.coalesce(F.sum(F.when(inside, units)), F.lit(0)).cast(INT).alias("_sx"),
        F.coalesce(F.sum(F.when(inside, units * units)), F.lit(0)).cast(INT).alias("_sxx"),
        F.first("_n_months").alias("total_months"),
    ]


def _variability_columns() -> list[Column]:
    m = as_int(F.col("total_months"))
    sx, sxx = F.col("_sx"), F.col("_sxx")
    avg = ratio_half_up(sx, m, 2)
    sd = sqrt_half_up(m * sxx - sx * sx, m * m, 2)
    return [avg.alias("avg_monthly_units"), sd.alias("stddev_monthly_units")]


def product_variability(monthly: DataFrame) -> DataFrame:
    """Mean and population sd of monthly units with absent months as 0.

    Written from moments: with M months, mean = Σx/M and
    sd = sqrt(MΣx² − (Σx)²)/M, so no product × month grid is built.
    """
    g = monthly.crossJoin(F.broadcast(_month_bounds(monthly))).groupBy("product_id").agg(
        *_variability_moments(monthly))
    g = g.where(F.col("total_months") > 0)
    return g.select("product_id", F.col("total_months").cast("int").alias("total_months"),
                    "active_months", *_variability_columns())


def months_at_once(df: DataFrame, month: Column) -> list[list]:
    """The months of ``df`` in runs of about ROWS_AT_ONCE rows."""
    counted = df.groupBy(month.alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()  # calendar months
    return in_parts({r.m: r.n for r in counted}, ROWS_AT_ONCE)


def of_months(run: list) -> Column:
    """The ``month_start`` is in the run."""
    dated = F.col("month_start").isin([F.lit(m).cast("date") for m in run if m is not None])
    return dated | F.col("month_start").isNull() if None in run else dated


def _product_sums(monthly: DataFrame) -> DataFrame:
    """Totals and moments by product.  All of them are sums, so the runs of months of a large mart are added to a staged
    table of products one by one: what is shuffled is a run and the products, not the mart."""
    sums = {"sales_count": "bigint", "units_sold": "bigint", "gross_revenue": D20, "discount_amount": D20, "revenue": D20,
            "active_months": "int", "_sx": INT, "_sxx": INT}
    bounds, runs, so_far = F.broadcast(_month_bounds(monthly)), months_at_once(monthly, F.col("month_start")), None
    inside, units = F.col("month_start") <= F.col("_max_complete"), F.col("units_sold").cast(INT)
    for i, run in enumerate(runs or [[]]):
        some = monthly if len(runs) < 2 else monthly.where(of_months(run))
        rows = some.crossJoin(bounds).select(
            "product_id", *list(sums)[:5], F.when(inside, 1).otherwise(0).alias("active_months"),
            F.when(inside, F.coalesce(units, F.lit(0))).otherwise(0).cast(INT).alias("_sx"),
            F.when(inside, F.coalesce(units * units, F.lit(0))).otherwise(0).cast(INT).alias("_sxx"),
            F.col("_n_months").alias("total_months"))
        added = (rows if so_far is None else so_far.unionByName(rows)).groupBy("product_id").agg(
            *[F.sum(c).cast(kind).alias(c) for c, kind in sums.items()], F.first("total_months").alias("total_months"))
        if i + 1 < len(runs):
            held = staged(added, "product-sums")
            if so_far is not None:
                unstage(so_far)
            so_far = held
    return added


def _revenue_shares(monthly: DataFrame, n_buckets: int | None) -> tuple[DataFrame, int]:
    """The products' totals, variability and shares of the revenue, and their number."""
    with scratch(monthly.sparkSession, kept=("products",)):
        metrics = staged(_product_metrics(monthly), "products")
    n = metrics.count()
    by_revenue = global_prefix(metrics, [desc("revenue"), asc("product_id")], ["revenue"], n_buckets,
                               materialize=False, n=n)
    shares = by_revenue.select(
        *metrics.columns,
        ratio_half_up(cents(F.col("revenue")), cents(F.col("total_revenue")), 8, precision=12)
        .alias("revenue_share"),
        ratio_half_up(cents(F.col("running_revenue")), cents(F.col("total_revenue")), 8, precision=12)
        .alias("cumulative_revenue_share"),
    )
    return shares, n


def _product_metrics(monthly: DataFrame) -> DataFrame:
    g = _product_sums(monthly).where(F.col("total_months") > 0)
    return g.select(
        "product_id", "sales_count", "units_sold", "gross_revenue", "discount_amount", "revenue",
        pct_half_up(F.col("discount_amount"), F.col("gross_revenue")).alias("weighted_discount_pct"),
        F.col("total_months").cast("int").alias("total_months"), "active_months",
        *_variability_columns(),
    ).withColumn("variation_coefficient",
                 ratio_half_up(cents(F.col("stddev_monthly_units")), cents(F.col("avg_monthly_units")),
                               4, precision=12))


def product_abc_xyz(monthly: DataFrame, n_buckets: int | None = None) -> DataFrame:
    spark = monthly.sparkSession
    with scratch(spark, kept=("ranked",)):
        shares, n = _revenue_shares(monthly, n_buckets)
        shares = staged(shares, "ranked")
    by_cv = global_prefix(shares, [asc("variation_coefficient"), asc("product_id")], [], n_buckets, materialize=False, n=n)
    unstage(shares)  # its rows lie in buckets now
    ranked = by_cv.withColumn("stability_percentile",
                              ratio_half_up(F.col("row_no"), F.col("n_rows"), 8, precision=12))
    abc = abc_class(F.col("cumulative_revenue_share"), Decimal(str(ABC_A)), Decimal(str(ABC_B)))
    xyz = xyz_class(F.col("stability_percentile"), F.lit(Decimal(str(XYZ_MART_X))),
                    F.lit(Decimal(str(XYZ_MART_Y))))
    out = ranked.withColumns({"abc_class": abc, "xyz_class": xyz})
    return out.select(
        "product_id", "sales_count", "units_sold", "gross_revenue", "discount_amount", "revenue",
        "weighted_discount_pct", "total_months", "active_months", "avg_monthly_units",
        "stddev_monthly_units", "variation_coefficient", "revenue_share", "cumulative_revenue_share",
        "stability_percentile", "abc_class", "xyz_class",
        F.concat("abc_class", "xyz_class").alias("abc_xyz_class"),
    )


MART_ORDER = ["daily_sales", "customer_rfm", "product_monthly_sales", "product_abc_xyz"]
#: Tables that the marts are kept up from: distinct ids of a day, client totals of a month.
PRESENCE, CLIENT_MONTHS = "daily_presence", "_client_months"


def in_months(date_col: Column, months) -> Column:
    """purchase_date inside any of the given month starts (range predicates,
    so the scan is pruned to those months' date partitions)."""
    cond = None
    for m in sorted(set(months)):
        m = F.lit(m).cast("date")
        c = (date_col >= m) & (date_col < F.add_months(m, 1))
        cond = c if cond is None else cond | c
    return cond if cond is not None else F.lit(False)


def _path(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def replace_table(df: DataFrame, path: str, by: list[str] = (), more: list[DataFrame] = ()) -> None:
    """Write beside the table, then swap folders: readers keep the old one until the new one is whole.  ``more``: frames
    that are written behind ``df``, one by one."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    new, fs = _path(spark, f"{path}__new-{tag}")
    for part in [df, *more]:
        with freed_shuffles(spark):
            part.write.mode("append").option("compression", CODEC).partitionBy(*by).parquet(new.toString())
    here, _ = _path(spark, path)
    old, _ = _path(spark, f"{path}__old-{tag}")
    fs.mkdirs(here.getParent())
    if fs.exists(here):
        fs.rename(here, old)
    if not fs.rename(new, here):
        raise RuntimeError(f"could not put {new.toString()} in place")
    fs.delete(old, True)


def _coverage_path(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/_coverage/{name}.json"


def covered_versions(spark, out: str, name: str) -> dict | None:
    """The dates, and their versions, that a mart was last built from; None if that isn't known."""
    text = read_text(spark, _coverage_path(out, name))
    return {dt.date.fromisoformat(d): v for d, v in json.loads(text).items()} if text is not None else None


def _cover(spark, out: str, name: str, versions: dict) -> None:
    """Written after the mart, so an interrupted refresh leaves dates to rebuild, never a wrong claim.  An entry a
    calendar day."""
    replace_text(spark, _coverage_path(out, name), json.dumps({d.isoformat(): v for d, v in sorted(versions.items())}))


def _refresh_by_month(build, sales: DataFrame, out: str, name: str, versions: dict, months: list) -> None:
    """Rebuild the months with a date that was added or replaced since the mart was built (and ``months``);
    all of them where the mart or its coverage is missing or a date has gone.  ``build`` takes the sales of
    some months and a filter of a table's ``month_start`` to them.  Of many sales a run of months is built at a time."""
    spark = sales.sparkSession
    path = f"{out.rstrip('/')}/{name}"
    covered = covered_versions(spark, out, name) if _exists(spark, path) else None

    def sales_in(run):
        rows = in_months(F.col("purchase_date"), [m for m in run if m is not None])
        return sales.where(rows | F.col("purchase_date").isNull() if None in run else rows)

    month = F.trunc("purchase_date", "MM")
    if covered is None or set(covered) - set(versions):
        runs = months_at_once(sales, month)
        if len(runs) < 2:
            replace_table(build(sales, F.lit(True)), path, ["month_start"])
        else:
            first, *more = [build(sales_in(run), of_months(run)) for run in runs]
            replace_table(first, path, ["month_start"], more)
    else:
        stale = sorted({d.replace(day=1) for d, v in versions.items() if covered.get(d) != v} | set(months))
        runs = months_at_once(sales_in(stale), month) if len(stale) > 1 else []
        for run in runs if len(runs) > 1 else [stale] if stale else []:
            with freed_shuffles(spark):
                (build(sales_in(run), of_months(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
                 .partitionBy("month_start").parquet(path))
    _cover(spark, out, name, versions)


def _by_month(df: DataFrame) -> DataFrame:
    """A month's rows in few files: adaptive execution splits large months and merges small ones."""
    return df.hint("rebalance", "month_start")


def _refresh_daily(sales: DataFrame, out: str, versions: dict, months: list) -> None:
    """The day's distinct ids, then the daily mart, which takes its distinct counts from them."""
    month = F.trunc("purchase_date", "MM").alias("month_start")
    _refresh_by_month(lambda s, _: _by_month(daily_presence(s).select("*", month)), sales, out, PRESENCE, versions, months)
    presence = sales.sparkSession.read.parquet(f"{out.rstrip('/')}/{PRESENCE}")
    _refresh_by_month(lambda s, of: _by_month(daily_sales(s, presence.where(of)).select("*", month)), sales, out, "daily_sales", versions, months)


def _refresh_rfm(sales: DataFrame, out: str, path: str, versions: dict) -> None:
    """RFM from the client-state table.

    The state stores client totals and the dates (with versions) that they cover.  When the table has
    those and more, only the new dates' rows are aggregated and merged — O(clients), not O(sales).
    Anything else (no state, a replaced or missing date) adds up the months' totals, of which only
    the months of added and replaced dates are built from sales."""
    spark = sales.sparkSession
    _refresh_by_month(lambda s, _: _by_month(client_months(s)), sales, out, CLIENT_MONTHS, versions, [])
    state_path = f"{out.rstrip('/')}/_client_state"
    covered = covered_versions(spark, out, "_client_state") if _exists(spark, state_path) else None
    if covered is None or any(versions.get(d) != v for d, v in covered.items()):
        state = totals_of_months(spark.read.parquet(f"{out.rstrip('/')}/{CLIENT_MONTHS}"))
    else:
        state = spark.read.parquet(state_path)
        new = [F.lit(d).cast("date") for d in versions if d not in covered]
        if new:
            state = merge_client_aggregates(state, client_aggregates(sales.where(F.col("purchase_date").isin(new))))
    if covered != versions:
        # Coverage goes first and comes back last: an interrupted replacement is rebuilt, not merged again.
        _cover(spark, out, "_client_state", {})
        replace_table(state, state_path)
        _cover(spark, out, "_client_state", versions)
    replace_table(rfm_from_metrics(metrics_from_aggregates(spark.read.parquet(state_path))), path)


def refresh_marts(sales: DataFrame, out: str, names: list[str] | None = None,
                  months: list | None = None, versions: dict | None = None) -> dict[str, str]:
    """Bring the marts up to the table, in dependency order.

    ``versions``: the table's dates and their load versions (``date_versions``; without it, the dates of
    ``sales``, each at version 0).  Each mart remembers the versions that it was built from and rebuilds what differs: date- and
    month-grain marts by month (dynamic partition overwrite), customer_rfm by merging new dates into the
    client state or, after a replaced date, from the months' client totals.  ``months`` are rebuilt in any case.  Ranks always cover whole tables — the client
    state, and for product_abc_xyz the stored monthly mart, never the raw fact."""
    wanted = set(names or MART_ORDER)
    if "product_abc_xyz" in wanted:
        wanted.add("product_monthly_sales")
    spark = sales.sparkSession
    if versions is None:
        versions = {r.purchase_date: 0 for r in sales.select("purchase_date").distinct().collect()}
    paths: dict[str, str] = {}
    for name in MART_ORDER:
        if name not in wanted:
            continue
        path = f"{out.rstrip('/')}/{name}"
        with scratch(spark):
            if name == "daily_sales":
                _refresh_daily(sales, out, versions, months or [])
            elif name == "product_monthly_sales":
                _refresh_by_month(lambda s, _: _by_month(product_monthly_sales(s)), sales, out, name, versions, months or [])
            elif name == "customer_rfm":
                _refresh_rfm(sales, out, path, versions)
            else:
                replace_table(product_abc_xyz(spark.read.parquet(paths["product_monthly_sales"])), path)
        paths[name] = path
    return paths
