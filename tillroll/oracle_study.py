"""DuckDB oracle SQL of the one-year studies (study year 1998, analysis date
1999-01-01 on the test fixture).  Plain SQL: global windows, quantile_cont,
a real product × 12-month grid."""

from __future__ import annotations

from tillroll.functions.classes import STUDY_CODE_PATTERNS
from tillroll.oracle import c2i, down, hu, hu_sqrt, with_sales
from tillroll.schema import CLASS_ORDER

YEAR = 1998
ANALYSIS_DATE = "1999-01-01"
CLASS_LIST = str(CLASS_ORDER)
PCTS = [0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
PCTS_SHORT = [0.10, 0.25, 0.50, 0.75, 0.90]


def qc(x: str, p: float, scale: int) -> str:
    return f"CAST(round(quantile_cont(CAST({x} AS DOUBLE), {p}), {scale}) AS DECIMAL(38,{scale}))"


SY = f"""sy AS (
  SELECT *, quantity * price_per_item AS gross_revenue, quantity * discount_per_item AS discount_amount,
    CAST(date_trunc('month', purchase_date) AS DATE) AS purchase_month
  FROM sales WHERE purchase_date >= DATE '{YEAR}-01-01' AND purchase_date < DATE '{YEAR + 1}-01-01')"""

PROFILE = f"""pp AS (
  SELECT product_id, count(DISTINCT sale_id) AS sales_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
    count(DISTINCT client_id) AS unique_clients, count(DISTINCT purchase_date) AS active_days,
    count(DISTINCT purchase_month) AS active_months, min(purchase_date) AS first_sale_date,
    max(purchase_date) AS last_sale_date,
    CAST(sum(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
    CAST(sum(discount_amount) AS DECIMAL(20,2)) AS discount_amount,
    CAST(sum(total_price) AS DECIMAL(20,2)) AS revenue
  FROM sy GROUP BY product_id),
product_profile AS (
  SELECT pp.*,
    {hu(c2i('gross_revenue'), 'units_sold * 100', 6)} AS avg_price_per_unit,
    {hu('units_sold', 'sales_count', 6)} AS avg_units_per_sale,
    {hu(c2i('revenue'), 'sales_count * 100', 6)} AS avg_sale_amount,
    {hu(c2i('discount_amount'), c2i('gross_revenue'), 6)} AS weighted_discount_pct,
    {hu(c2i('revenue'), 'unique_clients * 100', 6)} AS revenue_per_client
  FROM pp)"""

PROFILE_COLS = ("product_id, sales_count, units_sold, unique_clients, active_days, active_months, "
                "first_sale_date, last_sale_date, gross_revenue, discount_amount, revenue, avg_price_per_unit, "
                "avg_units_per_sale, avg_sale_amount, weighted_discount_pct, revenue_per_client")

ABC = f"""abc0 AS (
  SELECT pp.*, {c2i('revenue')} AS rc,
    {c2i('sum(revenue) OVER (ORDER BY revenue DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS run_c,
    {c2i('sum(revenue) OVER ()')} AS tot_c,
    row_number() OVER (ORDER BY revenue DESC, product_id) AS rn,
    count(*) OVER () AS n
  FROM product_profile pp),
abc_profile AS (
  SELECT {PROFILE_COLS},
    {hu('rc', 'tot_c', 8)} AS revenue_share,
    {hu('run_c', 'tot_c', 8)} AS cumulative_revenue_share,
    CASE WHEN tot_c = 0 THEN 'C' WHEN run_c * 100 <= tot_c * 80 THEN 'A'
         WHEN run_c * 100 < tot_c * 95 THEN 'B' ELSE 'C' END AS abc_class,
    rn AS product_rank,
    {hu('rn', 'n', 6, 100)} AS product_rank_pct
  FROM abc0)"""

XYZ = f"""mu AS (
  SELECT product_id, CAST(date_trunc('month', purchase_date) AS DATE) AS month_start,
    CAST(sum(quantity) AS BIGINT) AS units
  FROM sy GROUP BY 1, 2),
year_months AS (
  SELECT CAST(unnest(generate_series(DATE '{YEAR}-01-01', DATE '{YEAR}-12-01', INTERVAL 1 MONTH)) AS DATE) AS month_start),
grid AS (
  SELECT p.product_id, ym.month_start, COALESCE(mu.units, 0) AS x
  FROM (SELECT DISTINCT product_id FROM mu) p CROSS JOIN year_months ym
  LEFT JOIN mu ON mu.product_id = p.product_id AND mu.month_start = ym.month_start),
mom AS (
  SELECT product_id, count(*) AS m, sum(CAST(x AS HUGEINT)) AS sx, sum(CAST(x AS HUGEINT) * x) AS sxx
  FROM grid GROUP BY product_id),
xyz0 AS (
  SELECT product_id,
    {hu('sx', 'm', 6, 1, 24)} AS avg_monthly_units,
    {hu_sqrt('m * sxx - sx * sx', 'm * m', 6, 24)} AS std_monthly_units,
    CASE WHEN sx > 0 THEN {hu_sqrt('m * sxx - sx * sx', 'sx * sx', 6, 24)}
         WHEN sx < 0 THEN -{hu_sqrt('m * sxx - sx * sx', 'sx * sx', 6, 24)} END AS cv
  FROM mom),
xyz1 AS (
  SELECT *, CASE WHEN cv <= 0.10 THEN 'X' WHEN cv <= 0.25 THEN 'Y' ELSE 'Z' END AS xyz_class_classic
  FROM xyz0),
cvq AS (SELECT {qc('cv', 0.25, 8)} AS q25, {qc('cv', 0.75, 8)} AS q75 FROM xyz1),
xyz_profile AS (
  SELECT xyz1.*, CASE WHEN cv <= q25 THEN 'X' WHEN cv <= q75 THEN 'Y' ELSE 'Z' END AS xyz_class
  FROM xyz1 CROSS JOIN cvq)"""

ABC_XYZ = """abc_xyz_profile AS (
  SELECT a.*, x.avg_monthly_units, x.std_monthly_units, x.cv, x.xyz_class,
    a.abc_class || x.xyz_class AS abc_xyz_class
  FROM abc_profile a LEFT JOIN xyz_profile x ON x.product_id = a.product_id)"""

ABC_XYZ_SUMMARY = f"""axs0 AS (
  SELECT abc_xyz_class, count(DISTINCT product_id) AS products,
    CAST(sum(sales_count) AS BIGINT) AS sales_count, CAST(sum(units_sold) AS BIGINT) AS units_sold,
    CAST(sum(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
    CAST(sum(discount_amount) AS DECIMAL(20,2)) AS discount_amount,
    CAST(sum(revenue) AS DECIMAL(20,2)) AS revenue,
    {qc('cv', 0.5, 7)} AS median_cv
  FROM abc_xyz_profile GROUP BY abc_xyz_class),
abc_xyz_summary AS (
  SELECT abc_xyz_class, CAST(list_position({CLASS_LIST}, abc_xyz_class) AS INTEGER) AS class_order,
    products, sales_count, units_sold, gross_revenue, discount_amount, revenue, median_cv,
    {hu('products', 'sum(products) OVER ()', 6, 100)} AS products_pct,
    {hu(c2i('revenue'), c2i('sum(revenue) OVER ()'), 6, 100)} AS revenue_pct,
    {hu(c2i('discount_amount'), c2i('gross_revenue'), 6, 100)} AS weighted_discount_pct
  FROM axs0)"""

PMD = f"""pmd0 AS (
  SELECT product_id, purchase_month, count(DISTINCT sale_id) AS sales_count,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(sum(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
    CAST(sum(discount_amount) AS DECIMAL(20,2)) AS discount_amount,
    CAST(sum(total_price) AS DECIMAL(20,2)) AS revenue
  FROM sy GROUP BY product_id, purchase_month),
pmd1 AS (
  SELECT *, {hu(c2i('discount_amount'), c2i('gross_revenue'), 6, 100)} AS weighted_discount_pct FROM pmd0),
pmd2 AS (
  SELECT *, CAST(round(quantile_cont(CAST(weighted_discount_pct AS DOUBLE), 0.5)
      OVER (PARTITION BY product_id), 7) AS DECIMAL(38,7)) AS product_median_discount
  FROM pmd1),
product_month_discount AS (
  SELECT *, CASE WHEN weighted_discount_pct > product_median_discount THEN 'high' ELSE 'low' END AS discount_level
  FROM pmd2)"""


def _side(tag: str) -> str:
    return f"""{tag}_side AS (
  SELECT product_id, count(DISTINCT purchase_month) AS {tag}_months,
    sum(CAST(weighted_discount_pct * 1000000 AS HUGEINT)) AS sp, count(weighted_discount_pct) AS np,
    sum(CAST(units_sold AS HUGEINT)) AS su, sum(CAST(sales_count AS HUGEINT)) AS ss
  FROM product_month_discount WHERE discount_level = '{tag}' GROUP BY product_id)"""


RESPONSE = _side("low") + ",\n" + _side("high") + f""",
discount_response AS (
  SELECT l.product_id, l.low_months,
    {hu('l.sp', 'l.np * 1000000', 6)} AS low_discount_pct,
    {hu('l.su', 'l.low_months', 6)} AS low_units,
    {hu('l.ss', 'l.low_months', 6)} AS low_sales,
    h.high_months,
    {hu('h.sp', 'h.np * 1000000', 6)} AS high_discount_pct,
    {hu('h.su', 'h.high_months', 6)} AS high_units,
    {hu('h.ss', 'h.high_months', 6)} AS high_sales,
    {hu('h.sp * l.np - l.sp * h.np', 'l.np * h.np * 1000000', 6)} AS discount_gap_pp,
    {hu('h.su * l.low_months - l.su * h.high_months', 'l.su * h.high_months', 6, 100)} AS units_uplift_pct,
    {hu('h.ss * l.low_months - l.ss * h.high_months', 'l.ss * h.high_months', 6, 100)} AS sales_uplift_pct,
    a.abc_class, a.xyz_class, a.abc_xyz_class
  FROM low_side l JOIN high_side h ON h.product_id = l.product_id
  LEFT JOIN abc_xyz_profile a ON a.product_id = l.product_id
  WHERE l.low_months >= 2 AND h.high_months >= 2)"""

CLIENTS = f"""cp0 AS (
  SELECT client_id, arg_min(gender, sale_id) AS gender, min(purchase_date) AS first_purchase_date,
    max(purchase_date) AS last_purchase_date, count(DISTINCT sale_id) AS frequency,
    count(DISTINCT purchase_date) AS active_days, count(DISTINCT purchase_month) AS active_months,
    CAST(sum(quantity) AS BIGINT) AS units_purchased,
    CAST(sum(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
    CAST(sum(discount_amount) AS DECIMAL(20,2)) AS discount_amount,
    CAST(sum(total_price) AS DECIMAL(20,2)) AS revenue
  FROM sy GROUP BY client_id),
client_profile AS (
  SELECT *, CAST(DATE '{ANALYSIS_DATE}' - last_purchase_date AS BIGINT) AS recency_days,
    CAST(last_purchase_date - first_purchase_date + 1 AS BIGINT) AS customer_lifetime_days,
    {hu(c2i('revenue'), 'frequency * 100', 6)} AS avg_sale_amount,
    {hu('units_purchased', 'frequency', 6)} AS avg_units_per_sale,
    {hu('frequency', 'active_months', 6)} AS purchase_frequency_per_month,
    CASE WHEN gross_revenue > 0 THEN {hu(c2i('discount_amount'), c2i('gross_revenue'), 6, 100)}
         ELSE CAST(0 AS DECIMAL(20,6)) END AS weighted_discount_pct
  FROM cp0)"""

RANKED_CLIENTS = f"""rc AS (
  SELECT client_id, revenue, {c2i('revenue')} AS r_c,
    row_number() OVER (ORDER BY revenue DESC, client_id) AS rn, count(*) OVER () AS n,
    {c2i('sum(revenue) OVER (ORDER BY revenue DESC, client_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS run_c,
    {c2i('sum(revenue) OVER ()')} AS tot_c
  FROM client_profile)"""

RFM = """rq AS (
  SELECT client_id, recency_days, frequency, active_months, revenue, avg_sale_amount,
    row_number() OVER (ORDER BY recency_days, client_id) AS rr,
    row_number() OVER (ORDER BY revenue, client_id) AS mr,
    count(*) OVER () AS n
  FROM client_profile),
rs AS (
  SELECT *,
    CAST(6 - CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((rr - 1) * 5 + n - 2) // (n - 1)) END AS INTEGER) AS r_score,
    CAST(CASE WHEN frequency = 1 THEN 1 WHEN frequency = 2 THEN 2 WHEN frequency = 3 THEN 3
              WHEN frequency = 4 THEN 4 WHEN frequency >= 5 THEN 5 ELSE 0 END AS INTEGER) AS f_score,
    CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((mr - 1) * 5 + n - 2) // (n - 1)) END AS INTEGER) AS m_score
  FROM rq),
rfm_study AS (
  SELECT client_id, recency_days, frequency, active_months, revenue, avg_sale_amount, r_score, f_score,
    m_score, rf_score,
    CASE """ + " ".join(f"WHEN regexp_full_match(rf_score, '{pattern}') THEN '{name}'" for pattern, name in STUDY_CODE_PATTERNS) + """
         ELSE rf_score END AS rfm_segment
  FROM (SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) AS rf_score FROM rs))"""


def describe_sql(source: str, cols: list[str], pcts: list[float]) -> str:
    parts = []
    for c in cols:
        pc = ", ".join(f"{qc('v', p, 8)} AS p{int(round(p * 100)):02d}" for p in pcts)
        parts.append(
            f"""SELECT '{c}' AS "column", count(v) AS count,
  {hu('sum(CAST(v * 1000000 AS HUGEINT))', 'count(v) * 1000000', 6, 1, 38)} AS mean,
  CAST(round(stddev_samp(CAST(v AS DOUBLE)), 4) AS DECIMAL(38,4)) AS std, min(v) AS min, {pc}, max(v) AS max
FROM (SELECT CAST({c} AS DECIMAL(38,6)) AS v FROM {source})""")
    return "\nUNION ALL\n".join(parts)


def _a(*ctes: str) -> str:
    return with_sales(SY, *ctes)


STUDY_SQL = {
    "product_profile": _a(PROFILE) + "SELECT * FROM product_profile",
    "assortment_summary": _a(PROFILE) + f"""SELECT count(DISTINCT product_id) AS products,
  CAST(sum(sales_count) AS BIGINT) AS sales_count, CAST(sum(units_sold) AS BIGINT) AS units_sold,
  CAST(sum(revenue) AS DECIMAL(20,2)) AS revenue, CAST(sum(discount_amount) AS DECIMAL(20,2)) AS discount_amount,
  {hu(c2i('sum(discount_amount)'), c2i('sum(gross_revenue)'), 6, 100)} AS weighted_discount_pct,
  {qc('sales_count', 0.5, 1)} AS median_sales_per_product,
  {qc('revenue', 0.5, 3)} AS median_revenue_per_product,
  count(*) FILTER (WHERE active_months = 12) AS products_active_12_months
FROM product_profile""",
    "describe_products": _a(PROFILE) + describe_sql(
        "product_profile", ["sales_count", "units_sold", "unique_clients", "active_months", "revenue",
                            "weighted_discount_pct"], PCTS),
    "abc_profile": _a(PROFILE, ABC) + "SELECT * FROM abc_profile",
    "abc_summary": _a(PROFILE, ABC) + f"""SELECT abc_class, products,
  {hu('products', 'sum(products) OVER ()', 6, 100)} AS products_pct, sales_count, units_sold, revenue,
  {hu(c2i('revenue'), c2i('sum(revenue) OVER ()'), 6, 100)} AS revenue_pct
FROM (SELECT abc_class, count(DISTINCT product_id) AS products, CAST(sum(sales_count) AS BIGINT) AS sales_count,
        CAST(sum(units_sold) AS BIGINT) AS units_sold, CAST(sum(revenue) AS DECIMAL(20,2)) AS revenue
      FROM abc_profile GROUP BY abc_class)""",
    "monthly_demand_pivot": _a() + "SELECT product_id, " + ", ".join(
        f"CAST(sum(CASE WHEN month(purchase_date) = {m} THEN quantity ELSE 0 END) AS BIGINT) AS units_{m:02d}"
        for m in range(1, 13)) + " FROM sy GROUP BY product_id",
    "xyz_profile": _a(XYZ) + "SELECT * FROM xyz_profile",
    "xyz_classic_counts": _a(XYZ) + "SELECT xyz_class_classic, count(*) AS products FROM xyz_profile GROUP BY 1",
    "xyz_summary": _a(XYZ) + f"""SELECT xyz_class, products, cv_min, cv_median, cv_max, avg_monthly_units,
  {hu('products', 'sum(products) OVER ()', 6, 100)} AS products_pct
FROM (SELECT xyz_class, count(DISTINCT product_id) AS products, min(cv) AS cv_min, {qc('cv', 0.5, 7)} AS cv_median,
        max(cv) AS cv_max,
        {hu('sum(CAST(avg_monthly_units * 1000000 AS HUGEINT))', 'count(avg_monthly_units) * 1000000', 6, 1, 24)} AS avg_monthly_units
      FROM xyz_profile GROUP BY xyz_class)""",
    "cv_histogram": _a(XYZ) + f"""SELECT bins.bin,
  {down('(b.lo * 60 + (b.hi - b.lo) * (bins.bin - 1)) // 60', 6, 24)} AS bin_start,
  {down('(b.lo * 60 + (b.hi - b.lo) * bins.bin) // 60', 6, 24)} AS bin_end,
  COALESCE(c.products, 0) AS products
FROM (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 61) t(i)) bins
CROSS JOIN (SELECT CAST(min(cv) * 1000000 AS HUGEINT) AS lo, CAST(max(cv) * 1000000 AS HUGEINT) AS hi
            FROM xyz_profile WHERE cv IS NOT NULL) b
LEFT JOIN (SELECT CAST(CASE WHEN b2.hi = b2.lo THEN 1
                  ELSE least(60, ((CAST(cv * 1000000 AS HUGEINT) - b2.lo) * 60) // (b2.hi - b2.lo) + 1) END AS INTEGER) AS bin,
             count(*) AS products
           FROM xyz_profile
           CROSS JOIN (SELECT CAST(min(cv) * 1000000 AS HUGEINT) AS lo, CAST(max(cv) * 1000000 AS HUGEINT) AS hi
                       FROM xyz_profile WHERE cv IS NOT NULL) b2
           WHERE cv IS NOT NULL GROUP BY 1) c ON c.bin = bins.bin""",
    "describe_cv": _a(XYZ) + describe_sql("xyz_profile", ["cv"], PCTS_SHORT),
    "abc_xyz_profile": _a(PROFILE, ABC, XYZ, ABC_XYZ) + "SELECT * FROM abc_xyz_profile",
    "abc_xyz_summary": _a(PROFILE, ABC, XYZ, ABC_XYZ, ABC_XYZ_SUMMARY) + "SELECT * FROM abc_xyz_summary ORDER BY class_order",
    "abc_xyz_matrix": _a(PROFILE, ABC, XYZ, ABC_XYZ, ABC_XYZ_SUMMARY) + """SELECT a.abc_class,
  max(CASE WHEN s.xyz = 'X' THEN s.revenue_pct END) AS "X",
  max(CASE WHEN s.xyz = 'Y' THEN s.revenue_pct END) AS "Y",
  max(CASE WHEN s.xyz = 'Z' THEN s.revenue_pct END) AS "Z"
FROM (VALUES ('A'), ('B'), ('C')) a(abc_class)
LEFT JOIN (SELECT substr(abc_xyz_class, 1, 1) AS abc_class, substr(abc_xyz_class, 2, 1) AS xyz, revenue_pct
           FROM abc_xyz_summary) s ON s.abc_class = a.abc_class
GROUP BY a.abc_class ORDER BY a.abc_class""",
    "product_month_discount": _a(PMD) + "SELECT * FROM product_month_discount",
    "discount_response": _a(PROFILE, ABC, XYZ, ABC_XYZ, PMD, RESPONSE) + "SELECT * FROM discount_response",
    "discount_summary": _a(PROFILE, ABC, XYZ, ABC_XYZ, PMD, RESPONSE) + f"""SELECT abc_xyz_class,
  CAST(list_position({CLASS_LIST}, abc_xyz_class) AS INTEGER) AS class_order,
  count(DISTINCT product_id) AS products,
  {qc('discount_gap_pp', 0.5, 7)} AS median_discount_gap_pp,
  {qc('units_uplift_pct', 0.5, 7)} AS median_units_uplift_pct,
  {qc('sales_uplift_pct', 0.5, 7)} AS median_sales_uplift_pct,
  {hu('count(*) FILTER (WHERE units_uplift_pct > 0)', 'count(*)', 6, 100)} AS positive_units_response_pct
FROM discount_response GROUP BY abc_xyz_class ORDER BY class_order""",
    "discount_means": _a(PROFILE, ABC, XYZ, ABC_XYZ, PMD, RESPONSE) + f"""SELECT abc_xyz_class,
  CAST(round({qc('sales_uplift_pct', 0.5, 7)}, 4) AS DECIMAL(38,4)) AS median_sales_uplift_pct,
  {hu('sum(CAST(sales_uplift_pct * 1000000 AS HUGEINT))', 'count(sales_uplift_pct) * 1000000', 4, 1, 38)} AS mean_sales_uplift_pct,
  CAST(round({qc('units_uplift_pct', 0.5, 7)}, 4) AS DECIMAL(38,4)) AS median_units_uplift_pct
FROM discount_response GROUP BY abc_xyz_class""",
    "describe_uplift": _a(PROFILE, ABC, XYZ, ABC_XYZ, PMD, RESPONSE) + describe_sql(
        "discount_response", ["sales_uplift_pct", "units_uplift_pct"], PCTS_SHORT),
    "client_profile": _a(CLIENTS) + "SELECT * FROM client_profile",
    "client_checks": _a(CLIENTS) + f"""SELECT count(DISTINCT client_id) AS clients,
  count(*) FILTER (WHERE frequency = 1) AS one_purchase_clients,
  count(*) FILTER (WHERE frequency >= 2) AS repeat_clients,
  count(*) FILTER (WHERE frequency >= 5) AS five_plus_purchases,
  count(*) FILTER (WHERE revenue = 0) AS zero_revenue_clients,
  count(*) FILTER (WHERE units_purchased = 0) AS zero_units_clients,
  {hu('count(*) FILTER (WHERE frequency >= 2)', 'count(*)', 6, 100)} AS repeat_rate_pct,
  {hu('count(*) FILTER (WHERE frequency >= 5)', 'count(*)', 6, 100)} AS five_plus_rate_pct
FROM client_profile""",
    "describe_clients": _a(CLIENTS) + describe_sql(
        "client_profile", ["recency_days", "frequency", "active_days", "active_months", "units_purchased",
                           "revenue", "avg_sale_amount", "purchase_frequency_per_month",
                           "weighted_discount_pct"], PCTS),
    "frequency_profile": _a(CLIENTS) + f"""SELECT frequency, clients, revenue,
  {hu('clients', 'sum(clients) OVER ()', 6, 100)} AS clients_pct,
  {hu(c2i('revenue'), c2i('sum(revenue) OVER ()'), 6, 100)} AS revenue_pct
FROM (SELECT frequency, count(*) AS clients, CAST(sum(revenue) AS DECIMAL(20,2)) AS revenue
      FROM client_profile GROUP BY frequency) ORDER BY frequency""",
    "client_pareto": _a(CLIENTS, RANKED_CLIENTS) + f"""SELECT client_id, revenue, rn AS client_rank,
  {hu('rn', 'n', 6, 100)} AS cumulative_clients_pct,
  {hu('run_c', 'tot_c', 6, 100)} AS cumulative_revenue_pct
FROM rc""",
    "pareto_summary": _a(CLIENTS, RANKED_CLIENTS) + f"""SELECT t.s AS top_clients_pct,
  {hu('sum(CASE WHEN rn * 100 <= n * t.s THEN r_c ELSE 0 END)', 'sum(r_c)', 6, 100)} AS revenue_pct
FROM rc CROSS JOIN (VALUES (1), (5), (10), (20), (50)) t(s) GROUP BY t.s""",
    "rfm_study": _a(CLIENTS, RFM) + "SELECT * FROM rfm_study",
    "rfm_profile": _a(CLIENTS, RFM) + f"""SELECT rfm_segment, count(*) AS clients,
  {hu('sum(recency_days)', 'count(*)', 2)} AS avg_recency_days,
  {hu('sum(frequency)', 'count(*)', 2)} AS avg_frequency,
  {hu('sum(active_months)', 'count(*)', 2)} AS avg_active_months,
  {hu('sum(CAST(avg_sale_amount * 1000000 AS HUGEINT))', 'count(avg_sale_amount) * 1000000', 2)} AS avg_sale_amount,
  {hu(f"sum({c2i('revenue')})", 'count(*) * 100', 2)} AS avg_revenue_per_client,
  {hu(f"sum({c2i('revenue')})", '100', 2)} AS revenue,
  {hu('count(*)', 'sum(count(*)) OVER ()', 2, 100)} AS clients_pct,
  {hu(f"sum({c2i('revenue')})", f"sum(sum({c2i('revenue')})) OVER ()", 2, 100)} AS revenue_pct
FROM rfm_study GROUP BY rfm_segment ORDER BY revenue DESC""",
}
