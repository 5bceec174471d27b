"""One-year assortment study: product profile, ABC, XYZ, ABC–XYZ matrix and
the discount-response comparison.

Ratios are exact and rounded once: shares to 8 places, other ratios and
percentages to 6.  Whole-table orders use ``global_prefix``; medians and
quantiles use ``exact_percentiles`` (no group is gathered in one task).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.classes import class_ordinal, xyz_class
from tillroll.functions.dates import in_year
from tillroll.functions.numeric import (INT, as_int, cents, int_div, ratio_half_up, scale_down,
                                        sqrt_half_up, unscaled)
from tillroll.operators.ranks import asc, desc, global_prefix
from tillroll.operators.stats import describe_long, exact_percentiles, medians_by
from tillroll.plans.marts import D20, with_amounts
from tillroll.sources.sales_table import assert_unique
from tillroll.session import staged
from tillroll.schema import (ABC_A, ABC_B, DESCRIBE_PCTS, DESCRIBE_PCTS_SHORT, XYZ_CLASSIC_X,
                             XYZ_CLASSIC_Y)

R6 = 6   # places of ratios and percentages
S8 = 8   # places of shares
HIST_BINS = 60


def read_year(sales: DataFrame, year: int) -> DataFrame:
    """Sales of one calendar year (a date range: prunes date partitions)."""
    return sales.where(in_year(F.col("purchase_date"), year))


def _pct_of_total(df: DataFrame, specs: dict[str, tuple[str, int]]) -> DataFrame:
    """Add out = 100 * col / sum(col) for each out: (col, units scale)."""
    tot = df.agg(*[F.sum(unscaled(F.col(c), sc)).alias(f"_tot_{o}") for o, (c, sc) in specs.items()])
    out = df.crossJoin(F.broadcast(tot))
    for o, (c, sc) in specs.items():
        out = out.withColumn(o, ratio_half_up(unscaled(F.col(c), sc), F.col(f"_tot_{o}"), R6, 100))
    return out.drop(*[f"_tot_{o}" for o in specs])


# ------------------------------------------------------------ profile ------

def distinct_days(day: str = "purchase_date") -> Column:
    """Distinct days of one year: a bit a day in six longs, merged map-side, no row expansion."""
    place = f"(dayofyear({day}) - 1)"
    words = [f"bit_count(bit_or(if({place} div 64 = {k}, shiftleft(1L, cast({place} % 64 as int)), 0L)))" for k in range(6)]
    return F.expr(f"cast({' + '.join(words)} as bigint)")


def distinct_months(day: str = "purchase_date") -> Column:
    """Distinct months of one year, likewise."""
    return F.expr(f"cast(bit_count(bit_or(shiftleft(1, month({day})))) as bigint)")


def product_profile(sales_year: DataFrame) -> DataFrame:
    s = with_amounts(sales_year)
    g = s.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sales_count"),  # sale_id is unique by the table's contract
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.count_distinct("client_id").alias("unique_clients"),
        distinct_days().alias("active_days"),
        distinct_months().alias("active_months"),
        F.min("purchase_date").alias("first_sale_date"),
        F.max("purchase_date").alias("last_sale_date"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("total_price").cast(D20).alias("revenue"),
    )
    return g.withColumns({
        "avg_price_per_unit": ratio_half_up(cents(F.col("gross_revenue")), F.col("units_sold") * 100, R6),
        "avg_units_per_sale": ratio_half_up(F.col("units_sold"), F.col("sales_count"), R6),
        "avg_sale_amount": ratio_half_up(cents(F.col("revenue")), F.col("sales_count") * 100, R6),
        # A ratio here (not ×100), as in the source study.
        "weighted_discount_pct": ratio_half_up(cents(F.col("discount_amount")), cents(F.col("gross_revenue")), R6),
        "revenue_per_client": ratio_half_up(cents(F.col("revenue")), F.col("unique_clients") * 100, R6),
    })


def assortment_summary(profile: DataFrame) -> DataFrame:
    g = profile.agg(
        F.count_distinct("product_id").alias("products"),
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.sum("revenue").cast(D20).alias("revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("gross_revenue").alias("_gross"),
        F.count_if(F.col("active_months") == 12).alias("products_active_12_months"),
    )
    med = medians_by(profile, [], ["sales_count", "revenue"], "decimal(20,2)",
                     ["median_sales_per_product", "median_revenue_per_product"])
    out = g.crossJoin(F.broadcast(med))
    return out.select(
        "products", "sales_count", "units_sold", "revenue", "discount_amount",
        ratio_half_up(cents(F.col("discount_amount")), cents(F.col("_gross")), R6, 100)
        .alias("weighted_discount_pct"),
        F.col("median_sales_per_product").cast("decimal(38,1)").alias("median_sales_per_product"),
        F.col("median_revenue_per_product").cast("decimal(38,3)").alias("median_revenue_per_product"),
        "products_active_12_months",
    )


def describe_products(profile: DataFrame) -> DataFrame:
    cols = ["sales_count", "units_sold", "unique_clients", "active_months", "revenue",
            "weighted_discount_pct"]
    return describe_long(profile, cols, DESCRIBE_PCTS)


# ---------------------------------------------------------------- ABC ------

def abc_profile(profile: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Running revenue share in revenue order (ties by product id); A up to
    0.80, B strictly below 0.95, else C — decided on the exact share."""
    p = global_prefix(profile, [desc("revenue"), asc("product_id")], ["revenue"], n_buckets)
    run, tot = cents(F.col("running_revenue")), cents(F.col("total_revenue"))
    a = int(round(ABC_A * 100))
    b = int(round(ABC_B * 100))
    cls = (F.when(tot == 0, "C")
           .when(run * 100 <= tot * a, "A")
           .when(run * 100 < tot * b, "B")
           .otherwise("C"))
    return p.select(
        *profile.columns,
        ratio_half_up(cents(F.col("revenue")), tot, S8).alias("revenue_share"),
        ratio_half_up(run, tot, S8).alias("cumulative_revenue_share"),
        cls.alias("abc_class"),
        F.col("row_no").alias("product_rank"),
        ratio_half_up(F.col("row_no"), F.col("n_rows"), R6, 100).alias("product_rank_pct"),
    )


def abc_summary(abc: DataFrame) -> DataFrame:
    g = abc.groupBy("abc_class").agg(
        F.count_distinct("product_id").alias("products"),
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.sum("revenue").cast(D20).alias("revenue"),
    )
    g = _pct_of_total(g, {"products_pct": ("products", 0), "revenue_pct": ("revenue", 2)})
    return g.select("abc_class", "products", "products_pct", "sales_count", "units_sold", "revenue",
                    "revenue_pct")


# ---------------------------------------------------------------- XYZ ------

def monthly_units(sales_year: DataFrame) -> DataFrame:
    """Units per (product, month) — the long form of the demand matrix."""
    return (sales_year.groupBy("product_id", F.trunc("purchase_date", "MM").alias("purchase_month"))
            .agg(F.sum("quantity").cast("bigint").alias("units")))


def monthly_demand_pivot(sales_year: DataFrame, year: int) -> DataFrame:
    """Product × 12 months of units, absent months 0 (one aggregate, the
    month list is given so no distinct pass is needed)."""
    months = [f"{year}-{m:02d}-01" for m in range(1, 13)]
    s = sales_year.withColumn("_m", F.date_format("purchase_date", "yyyy-MM-01"))
    wide = s.groupBy("product_id").pivot("_m", months).agg(F.sum("quantity").cast("bigint"))
    return wide.select("product_id", *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(f"units_{i + 1:02d}")
                                       for i, m in enumerate(months)])


def _cv(sx: Column, sxx: Column, months: int) -> Column:
    """Population sd / mean of monthly units = sign(Σx)·sqrt(MΣx² − (Σx)²)/|Σx|."""
    a = sxx * months - sx * sx
    mag = sqrt_half_up(a, sx * sx, R6, precision=24)
    return F.when(sx > 0, mag).when(sx < 0, -mag)


def xyz_profile(sales_year: DataFrame, year: int) -> DataFrame:
    """Monthly demand stability over the 12 months of ``year``: classic
    classes (CV ≤ 0.10 X, ≤ 0.25 Y) and adaptive ones (quartiles of CV)."""
    m = 12
    mu = monthly_units(sales_year)
    g = mu.groupBy("product_id").agg(
        F.sum(as_int(F.col("units"))).cast(INT).alias("_sx"),
        F.sum(as_int(F.col("units")) * as_int(F.col("units"))).cast(INT).alias("_sxx"),
    )
    sx, sxx = F.col("_sx"), F.col("_sxx")
    base = g.select(
        "product_id",
        ratio_half_up(sx, F.lit(m), R6, precision=24).alias("avg_monthly_units"),
        sqrt_half_up(sxx * m - sx * sx, F.lit(m * m), R6, precision=24).alias("std_monthly_units"),
        _cv(sx, sxx, m).alias("cv"),
    ).withColumn("xyz_class_classic", xyz_class(F.col("cv"), F.lit(Decimal(str(XYZ_CLASSIC_X))),
                                                F.lit(Decimal(str(XYZ_CLASSIC_Y)))))
    base = staged(base, "xyz")
    q = exact_percentiles(base, "cv", [0.25, 0.75], names=["cv_q25", "cv_q75"])
    out = base.crossJoin(F.broadcast(q))
    return out.withColumn("xyz_class", xyz_class(F.col("cv"), F.col("cv_q25"), F.col("cv_q75"))) \
        .drop("cv_q25", "cv_q75")


def xyz_classic_counts(xyz: DataFrame) -> DataFrame:
    return xyz.groupBy("xyz_class_classic").agg(F.count(F.lit(1)).alias("products"))


def xyz_summary(xyz: DataFrame) -> DataFrame:
    g = xyz.groupBy("xyz_class").agg(
        F.count_distinct("product_id").alias("products"),
        F.min("cv").alias("cv_min"),
        F.max("cv").alias("cv_max"),
        F.sum(unscaled(F.col("avg_monthly_units"), R6)).alias("_su"),
        F.count("avg_monthly_units").alias("_nu"),
    )
    med = exact_percentiles(xyz, "cv", [0.5], ["xyz_class"], names=["cv_median"])
    g = g.join(med, "xyz_class", "left")
    g = _pct_of_total(g, {"products_pct": ("products", 0)})
    return g.select(
        "xyz_class", "products", "cv_min", F.col("cv_median").cast("decimal(38,7)").alias("cv_median"),
        "cv_max",
        ratio_half_up(F.col("_su"), F.col("_nu") * F.lit(10 ** R6), R6, precision=24).alias("avg_monthly_units"),
        "products_pct",
    )


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS, scale: int = R6) -> DataFrame:
    """Equal-width bins between min and max of a DECIMAL column (last bin
    closed), every bin listed with its edges; bin numbers from exact integer
    arithmetic on the column's smallest units (``scale`` places)."""
    v = df.where(F.col(col).isNotNull())
    bounds = v.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    lo_u, hi_u = unscaled(F.col("_lo"), scale), unscaled(F.col("_hi"), scale)
    width = hi_u - lo_u
    off = unscaled(F.col(col), scale) - lo_u
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.lit(bins), int_div(off * bins, F.greatest(width, F.lit(1))).cast("int") + 1))
    counts = v.crossJoin(F.broadcast(bounds)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("products"))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    grid = grid.crossJoin(F.broadcast(bounds))
    edge = lambda k: scale_down(int_div(as_int(lo_u) * bins + width * k, F.lit(bins)), scale, 24)
    grid = grid.select("bin", edge(F.col("bin") - 1).alias("bin_start"), edge(F.col("bin")).alias("bin_end"))
    return grid.join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce(F.col("products"), F.lit(0)).alias("products"))


def cv_histogram(xyz: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """The 60-bin distribution of the demand CV (the data behind the plot)."""
    return histogram(xyz, "cv", bins)


def describe_cv(xyz: DataFrame) -> DataFrame:
    return describe_long(xyz, ["cv"], DESCRIBE_PCTS_SHORT)


# ------------------------------------------------------------ ABC–XYZ -------

def check_one_to_one(*sides: DataFrame, key: str = "product_id") -> None:
    """Raise when a join side repeats its key (the 1:1 merge contract).
    One small job per side; both sides here are grouped on the key, so the
    check is optional."""
    for side in sides:
        if assert_unique(side.select(key), [key]).limit(1).count():
            raise ValueError(f"join side is not unique on {key}")


def abc_xyz_profile(abc: DataFrame, xyz: DataFrame, validate: bool = False) -> DataFrame:
    """Left join on product_id; both sides are one row per product (grouped
    on it), so the join is 1:1 and co-partitioned."""
    if validate:
        check_one_to_one(abc, xyz)
    x = xyz.select("product_id", "avg_monthly_units", "std_monthly_units", "cv", "xyz_class")
    return abc.join(x, "product_id", "left").withColumn(
        "abc_xyz_class", F.concat(F.col("abc_class"), F.col("xyz_class")))


def abc_xyz_summary(p: DataFrame) -> DataFrame:
    g = p.groupBy("abc_xyz_class").agg(
        F.count_distinct("product_id").alias("products"),
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("revenue").cast(D20).alias("revenue"),
    )
    med = exact_percentiles(p, "cv", [0.5], ["abc_xyz_class"], names=["median_cv"])
    g = g.join(med, "abc_xyz_class", "left")
    g = _pct_of_total(g, {"products_pct": ("products", 0), "revenue_pct": ("revenue", 2)})
    return g.select(
        "abc_xyz_class", class_ordinal(F.col("abc_xyz_class")).alias("class_order"),
        "products", "sales_count", "units_sold", "gross_revenue", "discount_amount", "revenue",
        F.col("median_cv").cast("decimal(38,7)").alias("median_cv"), "products_pct", "revenue_pct",
        ratio_half_up(cents(F.col("discount_amount")), cents(F.col("gross_revenue")), R6, 100)
        .alias("weighted_discount_pct"),
    ).orderBy("class_order")


def abc_xyz_matrix(summary: DataFrame) -> DataFrame:
    """3 × 3 revenue-% matrix: rows A/B/C, columns X/Y/Z."""
    s = summary.select(F.substring("abc_xyz_class", 1, 1).alias("abc_class"),
                       F.substring("abc_xyz_class", 2, 1).alias("xyz_class"), "revenue_pct")
    wide = s.groupBy("abc_class").pivot("xyz_class", ["X", "Y", "Z"]).agg(F.first("revenue_pct"))
    rows = summary.sparkSession.createDataFrame([("A",), ("B",), ("C",)], "abc_class string")
    return rows.join(wide, "abc_class", "left").select("abc_class", "X", "Y", "Z").orderBy("abc_class")


# ----------------------------------------------------- discount response ---

def product_month_discount(sales_year: DataFrame) -> DataFrame:
    """Product-month table with the weighted discount %, the product's median
    over its months, and the level (above the median → high, else low).
    A product has at most 12 months, so its median window is bounded."""
    s = with_amounts(sales_year)
    g = s.groupBy("product_id", "purchase_month").agg(
        F.count(F.lit(1)).alias("sales_count"),  # sale_id is unique by the table's contract
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("total_price").cast(D20).alias("revenue"),
    )
    g = g.withColumn("weighted_discount_pct",
                     ratio_half_up(cents(F.col("discount_amount")), cents(F.col("gross_revenue")), R6, 100))
    w = Window.partitionBy("product_id")
    med = F.round(F.median("weighted_discount_pct").over(w), R6 + 1).cast(f"decimal(38,{R6 + 1})")
    g = g.withColumn("product_median_discount", med)
    return g.withColumn("discount_level", F.when(F.col("weighted_discount_pct") > F.col("product_median_discount"),
                                                 "high").otherwise("low"))


def discount_response(pmd: DataFrame, abc_xyz: DataFrame, validate: bool = False) -> DataFrame:
    """Per product, low- vs high-discount months in one conditional
    aggregate (the low and high sides of one product are joined by
    construction); kept when each side has at least two months."""
    if validate:
        check_one_to_one(abc_xyz)
    low = F.col("discount_level") == "low"
    high = ~low
    pct_u = unscaled(F.col("weighted_discount_pct"), R6)

    def side(cond: Column, tag: str) -> list[Column]:
        return [
            F.count(F.when(cond, F.lit(1))).alias(f"{tag}_months"),
            F.sum(F.when(cond, pct_u)).alias(f"_{tag}_sp"),
            F.count(F.when(cond, pct_u)).alias(f"_{tag}_np"),
            F.sum(F.when(cond, F.col("units_sold"))).cast(INT).alias(f"_{tag}_su"),
            F.sum(F.when(cond, F.col("sales_count"))).cast(INT).alias(f"_{tag}_ss"),
        ]

    g = pmd.groupBy("product_id").agg(*side(low, "low"), *side(high, "high"))
    g = g.where((F.col("low_months") >= 2) & (F.col("high_months") >= 2))
    nl, nh = as_int(F.col("low_months")), as_int(F.col("high_months"))
    spl, sph = as_int(F.col("_low_sp")), as_int(F.col("_high_sp"))
    npl, nph = as_int(F.col("_low_np")), as_int(F.col("_high_np"))
    sul, suh = F.col("_low_su"), F.col("_high_su")
    ssl, ssh = F.col("_low_ss"), F.col("_high_ss")
    e6 = F.lit(10 ** R6)
    out = g.select(
        "product_id",
        F.col("low_months").cast("bigint").alias("low_months"),
        ratio_half_up(spl, npl * e6, R6).alias("low_discount_pct"),
        ratio_half_up(sul, nl, R6).alias("low_units"),
        ratio_half_up(ssl, nl, R6).alias("low_sales"),
        F.col("high_months").cast("bigint").alias("high_months"),
        ratio_half_up(sph, nph * e6, R6).alias("high_discount_pct"),
        ratio_half_up(suh, nh, R6).alias("high_units"),
        ratio_half_up(ssh, nh, R6).alias("high_sales"),
        ratio_half_up(sph * npl - spl * nph, npl * nph * e6, R6).alias("discount_gap_pp"),
        ratio_half_up(suh * nl - sul * nh, sul * nh, R6, 100).alias("units_uplift_pct"),
        ratio_half_up(ssh * nl - ssl * nh, ssl * nh, R6, 100).alias("sales_uplift_pct"),
    )
    classes = abc_xyz.select("product_id", "abc_class", "xyz_class", "abc_xyz_class")
    return out.join(classes, "product_id", "left")


def discount_summary(resp: DataFrame) -> DataFrame:
    g = resp.groupBy("abc_xyz_class").agg(
        F.count_distinct("product_id").alias("products"),
        F.count_if(F.col("units_uplift_pct") > 0).alias("_pos"),
        F.count(F.lit(1)).alias("_n"),
    )
    med = medians_by(resp, ["abc_xyz_class"], ["discount_gap_pp", "units_uplift_pct", "sales_uplift_pct"],
                     f"decimal(24,{R6})",
                     ["median_discount_gap_pp", "median_units_uplift_pct", "median_sales_uplift_pct"])
    g = g.join(med, "abc_xyz_class", "left")
    d7 = f"decimal(38,{R6 + 1})"
    return g.select(
        "abc_xyz_class", class_ordinal(F.col("abc_xyz_class")).alias("class_order"), "products",
        F.col("median_discount_gap_pp").cast(d7).alias("median_discount_gap_pp"),
        F.col("median_units_uplift_pct").cast(d7).alias("median_units_uplift_pct"),
        F.col("median_sales_uplift_pct").cast(d7).alias("median_sales_uplift_pct"),
        ratio_half_up(F.col("_pos"), F.col("_n"), R6, 100).alias("positive_units_response_pct"),
    ).orderBy("class_order")


def discount_means(resp: DataFrame) -> DataFrame:
    g = resp.groupBy("abc_xyz_class").agg(
        F.sum(unscaled(F.col("sales_uplift_pct"), R6)).alias("_s"),
        F.count("sales_uplift_pct").alias("_n"),
    )
    med = medians_by(resp, ["abc_xyz_class"], ["sales_uplift_pct", "units_uplift_pct"], f"decimal(24,{R6})",
                     ["_ms", "_mu"])
    g = g.join(med, "abc_xyz_class", "left")
    return g.select(
        "abc_xyz_class",
        F.round(F.col("_ms"), 4).cast("decimal(38,4)").alias("median_sales_uplift_pct"),
        ratio_half_up(F.col("_s"), F.col("_n") * F.lit(10 ** R6), 4, precision=38).alias("mean_sales_uplift_pct"),
        F.round(F.col("_mu"), 4).cast("decimal(38,4)").alias("median_units_uplift_pct"),
    )


def describe_uplift(resp: DataFrame) -> DataFrame:
    return describe_long(resp, ["sales_uplift_pct", "units_uplift_pct"], DESCRIBE_PCTS_SHORT)
