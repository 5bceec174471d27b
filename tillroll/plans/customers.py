"""One-year customer study: client profile, checks, purchase frequency,
revenue concentration (Pareto) and the RF-code segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.classes import rfm_segment_study
from tillroll.functions.numeric import as_int, cents, ratio_half_up, unscaled
from tillroll.operators.ranks import asc, desc, global_prefix, quantile_score
from tillroll.operators.stats import describe_long
from tillroll.plans.assortment import distinct_days, distinct_months
from tillroll.plans.marts import D20, with_amounts
from tillroll.session import staged
from tillroll.schema import DESCRIBE_PCTS, PARETO_SHARES

R6 = 6


def client_profile(sales_year: DataFrame, analysis_date) -> DataFrame:
    """One row per client of the year.  ``gender`` is the gender of the
    client's first sale by sale id (a deterministic 'first')."""
    s = with_amounts(sales_year)
    g = s.groupBy("client_id").agg(
        F.min_by("gender", "sale_id").alias("gender"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("frequency"),
        distinct_days().alias("active_days"),
        distinct_months().alias("active_months"),
        F.sum("quantity").cast("bigint").alias("units_purchased"),
        F.sum("gross_revenue").cast(D20).alias("gross_revenue"),
        F.sum("discount_amount").cast(D20).alias("discount_amount"),
        F.sum("total_price").cast(D20).alias("revenue"),
    )
    ad = F.lit(analysis_date).cast("date")
    return g.withColumns({
        "recency_days": F.datediff(ad, F.col("last_purchase_date")).cast("bigint"),
        "customer_lifetime_days": (F.datediff("last_purchase_date", "first_purchase_date") + 1).cast("bigint"),
        "avg_sale_amount": ratio_half_up(cents(F.col("revenue")), F.col("frequency") * 100, R6),
        "avg_units_per_sale": ratio_half_up(F.col("units_purchased"), F.col("frequency"), R6),
        "purchase_frequency_per_month": ratio_half_up(F.col("frequency"), F.col("active_months"), R6),
        "weighted_discount_pct": F.when(
            F.col("gross_revenue") > 0,
            ratio_half_up(cents(F.col("discount_amount")), cents(F.col("gross_revenue")), R6, 100),
        ).otherwise(F.lit(0).cast(f"decimal(20,{R6})")),
    })


def client_checks(profile: DataFrame) -> DataFrame:
    g = profile.agg(
        F.count_distinct("client_id").alias("clients"),
        F.count_if(F.col("frequency") == 1).alias("one_purchase_clients"),
        F.count_if(F.col("frequency") >= 2).alias("repeat_clients"),
        F.count_if(F.col("frequency") >= 5).alias("five_plus_purchases"),
        F.count_if(F.col("revenue") == 0).alias("zero_revenue_clients"),
        F.count_if(F.col("units_purchased") == 0).alias("zero_units_clients"),
        F.count(F.lit(1)).alias("_n"),
    )
    return g.withColumns({
        "repeat_rate_pct": ratio_half_up(F.col("repeat_clients"), F.col("_n"), R6, 100),
        "five_plus_rate_pct": ratio_half_up(F.col("five_plus_purchases"), F.col("_n"), R6, 100),
    }).drop("_n")


def describe_clients(profile: DataFrame) -> DataFrame:
    cols = ["recency_days", "frequency", "active_days", "active_months", "units_purchased", "revenue",
            "avg_sale_amount", "purchase_frequency_per_month", "weighted_discount_pct"]
    return describe_long(profile, cols, DESCRIBE_PCTS)


def frequency_profile(profile: DataFrame) -> DataFrame:
    g = profile.groupBy("frequency").agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum("revenue").cast(D20).alias("revenue"),
    )
    tot = g.agg(F.sum("clients").alias("_n"), F.sum(cents(F.col("revenue"))).alias("_r"))
    return g.crossJoin(F.broadcast(tot)).select(
        "frequency", "clients", "revenue",
        ratio_half_up(F.col("clients"), F.col("_n"), R6, 100).alias("clients_pct"),
        ratio_half_up(cents(F.col("revenue")), F.col("_r"), R6, 100).alias("revenue_pct"),
    ).orderBy("frequency")


def client_pareto(profile: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Clients in revenue order (ties by client id) with cumulative % of
    clients and of revenue — the concentration curve."""
    p = global_prefix(profile.select("client_id", "revenue"), [desc("revenue"), asc("client_id")],
                      ["revenue"], n_buckets)
    return p.select(
        "client_id", "revenue", F.col("row_no").alias("client_rank"),
        ratio_half_up(F.col("row_no"), F.col("n_rows"), R6, 100).alias("cumulative_clients_pct"),
        ratio_half_up(cents(F.col("running_revenue")), cents(F.col("total_revenue")), R6, 100)
        .alias("cumulative_revenue_pct"),
    )


def pareto_summary(profile: DataFrame, shares=PARETO_SHARES, n_buckets: int | None = None) -> DataFrame:
    """Revenue % held by the top s % of clients, for each s: one pass of
    conditional sums over the ranked clients (rank·100 ≤ s·n exactly)."""
    p = global_prefix(profile.select("client_id", "revenue"), [desc("revenue"), asc("client_id")],
                      ["revenue"], n_buckets)
    rc = cents(F.col("revenue"))
    g = p.agg(F.sum(rc).alias("_tot"),
              *[F.sum(F.when(as_int(F.col("row_no")) * 100 <= as_int(F.col("n_rows")) * s, rc)
                      .otherwise(0)).alias(f"_s{s}") for s in shares])
    rows = F.array(*[F.struct(F.lit(s).cast("int").alias("top_clients_pct"),
                              ratio_half_up(F.col(f"_s{s}"), F.col("_tot"), R6, 100).alias("revenue_pct"))
                     for s in shares])
    return g.select(F.inline(rows))


def rfm_study(profile: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """R and M from quintiles of rank-first order (R reversed), F from fixed
    purchase-count bands; the segment comes from the two-digit RF code."""
    base = staged(profile.select("client_id", "recency_days", "frequency", "active_months", "revenue",
                                 "avg_sale_amount"), "clients")
    r = global_prefix(base, [asc("recency_days"), asc("client_id")], [], n_buckets, materialize=False)
    r = r.withColumn("r_score", (6 - quantile_score(F.col("row_no"), F.col("n_rows"))).cast("int")) \
        .drop("row_no", "n_rows")
    m = global_prefix(r, [asc("revenue"), asc("client_id")], [], n_buckets)
    m = m.withColumn("m_score", quantile_score(F.col("row_no"), F.col("n_rows"))).drop("row_no", "n_rows")
    f = F.col("frequency")
    f_score = (F.when(f == 1, 1).when(f == 2, 2).when(f == 3, 3).when(f == 4, 4).when(f >= 5, 5)
               .otherwise(0).cast("int"))
    out = m.withColumn("f_score", f_score)
    out = out.withColumn("rf_score", F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string")))
    return out.withColumn("rfm_segment", rfm_segment_study(F.col("rf_score"))).select(
        "client_id", "recency_days", "frequency", "active_months", "revenue", "avg_sale_amount",
        "r_score", "f_score", "m_score", "rf_score", "rfm_segment")


def rfm_profile(rfm: DataFrame) -> DataFrame:
    """Segment means (rounded to 2), revenue and shares, by revenue."""
    e6 = F.lit(10 ** R6)
    g = rfm.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum("recency_days").alias("_rec"),
        F.sum("frequency").alias("_freq"),
        F.sum("active_months").alias("_am"),
        F.sum(unscaled(F.col("avg_sale_amount"), R6)).alias("_asa"),
        F.count("avg_sale_amount").alias("_nasa"),
        F.sum(cents(F.col("revenue"))).alias("_rev"),
    )
    tot = g.agg(F.sum("clients").alias("_n"), F.sum("_rev").alias("_r"))
    g = g.crossJoin(F.broadcast(tot))
    return g.select(
        "rfm_segment", "clients",
        ratio_half_up(F.col("_rec"), F.col("clients"), 2).alias("avg_recency_days"),
        ratio_half_up(F.col("_freq"), F.col("clients"), 2).alias("avg_frequency"),
        ratio_half_up(F.col("_am"), F.col("clients"), 2).alias("avg_active_months"),
        ratio_half_up(F.col("_asa"), F.col("_nasa") * e6, 2).alias("avg_sale_amount"),
        ratio_half_up(F.col("_rev"), F.col("clients") * 100, 2).alias("avg_revenue_per_client"),
        ratio_half_up(F.col("_rev"), F.lit(100), 2).alias("revenue"),
        ratio_half_up(F.col("clients"), F.col("_n"), 2, 100).alias("clients_pct"),
        ratio_half_up(F.col("_rev"), F.col("_r"), 2, 100).alias("revenue_pct"),
    ).orderBy(F.col("revenue").desc())
