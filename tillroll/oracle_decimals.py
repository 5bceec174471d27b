"""DECIMAL result columns per query (generated by tools/gen_decimal_columns.py).

The oracle casts these to DOUBLE, as the registry boundary does on the Spark side."""

DECIMAL_COLUMNS = {
    'abc_profile': ['gross_revenue', 'discount_amount', 'revenue', 'avg_price_per_unit', 'avg_units_per_sale', 'avg_sale_amount', 'weighted_discount_pct', 'revenue_per_client', 'revenue_share', 'cumulative_revenue_share', 'product_rank_pct'],
    'abc_summary': ['products_pct', 'revenue', 'revenue_pct'],
    'abc_xyz_matrix': ['X', 'Y', 'Z'],
    'abc_xyz_profile': ['gross_revenue', 'discount_amount', 'revenue', 'avg_price_per_unit', 'avg_units_per_sale', 'avg_sale_amount', 'weighted_discount_pct', 'revenue_per_client', 'revenue_share', 'cumulative_revenue_share', 'product_rank_pct', 'avg_monthly_units', 'std_monthly_units', 'cv'],
    'abc_xyz_summary': ['gross_revenue', 'discount_amount', 'revenue', 'median_cv', 'products_pct', 'revenue_pct', 'weighted_discount_pct'],
    'assortment_summary': ['revenue', 'discount_amount', 'weighted_discount_pct', 'median_sales_per_product', 'median_revenue_per_product'],
    'backfill_summary': [],
    'class_breakdown': ['revenue', 'products_pct', 'revenue_pct'],
    'client_activity': ['revenue', 'sales_per_client', 'revenue_per_client'],
    'client_checks': ['repeat_rate_pct', 'five_plus_rate_pct'],
    'client_pareto': ['revenue', 'cumulative_clients_pct', 'cumulative_revenue_pct'],
    'client_profile': ['gross_revenue', 'discount_amount', 'revenue', 'avg_sale_amount', 'avg_units_per_sale', 'purchase_frequency_per_month', 'weighted_discount_pct'],
    'customer_metrics': ['monetary', 'avg_sale_amount'],
    'customer_rfm': ['monetary', 'avg_sale_amount'],
    'cv_histogram': ['bin_start', 'bin_end'],
    'daily_activity': ['revenue', 'sales_per_client', 'revenue_per_client'],
    'daily_dynamics': ['revenue', 'gross_revenue', 'discount_amount', 'avg_sale_amount'],
    'daily_sales': ['gross_revenue', 'discount_amount', 'revenue', 'avg_sale_amount', 'weighted_discount_pct'],
    'describe_clients': ['mean', 'std', 'min', 'p10', 'p25', 'p50', 'p75', 'p90', 'p95', 'p99', 'max'],
    'describe_cv': ['mean', 'std', 'min', 'p10', 'p25', 'p50', 'p75', 'p90', 'max'],
    'describe_products': ['mean', 'std', 'min', 'p10', 'p25', 'p50', 'p75', 'p90', 'p95', 'p99', 'max'],
    'describe_uplift': ['mean', 'std', 'min', 'p10', 'p25', 'p50', 'p75', 'p90', 'max'],
    'discount_means': ['median_sales_uplift_pct', 'mean_sales_uplift_pct', 'median_units_uplift_pct'],
    'discount_response': ['low_discount_pct', 'low_units', 'low_sales', 'high_discount_pct', 'high_units', 'high_sales', 'discount_gap_pp', 'units_uplift_pct', 'sales_uplift_pct'],
    'discount_summary': ['median_discount_gap_pp', 'median_units_uplift_pct', 'median_sales_uplift_pct', 'positive_units_response_pct'],
    'existing_dates': [],
    'frequency_profile': ['revenue', 'clients_pct', 'revenue_pct'],
    'ingest_status': [],
    'ingested_sales': ['revenue'],
    'key_contract': [],
    'kpis': ['revenue', 'avg_sale_amount'],
    'landed_verdicts': [],
    'load_overview': [],
    'missing_dates': [],
    'monthly_demand_pivot': [],
    'pareto_summary': ['revenue_pct'],
    'product_abc_xyz': ['gross_revenue', 'discount_amount', 'revenue', 'weighted_discount_pct', 'avg_monthly_units', 'stddev_monthly_units', 'variation_coefficient', 'revenue_share', 'cumulative_revenue_share', 'stability_percentile'],
    'product_month_discount': ['gross_revenue', 'discount_amount', 'revenue', 'weighted_discount_pct', 'product_median_discount'],
    'product_monthly_sales': ['gross_revenue', 'discount_amount', 'revenue'],
    'product_profile': ['gross_revenue', 'discount_amount', 'revenue', 'avg_price_per_unit', 'avg_units_per_sale', 'avg_sale_amount', 'weighted_discount_pct', 'revenue_per_client'],
    'product_totals': ['gross_revenue', 'discount_amount', 'revenue', 'weighted_discount_pct'],
    'product_variability': ['avg_monthly_units', 'stddev_monthly_units'],
    'quarantine': [],
    'refreshed_customer_rfm': ['monetary', 'avg_sale_amount'],
    'refreshed_daily_sales': ['gross_revenue', 'discount_amount', 'revenue', 'avg_sale_amount', 'weighted_discount_pct'],
    'refreshed_product_abc_xyz': ['gross_revenue', 'discount_amount', 'revenue', 'weighted_discount_pct', 'avg_monthly_units', 'stddev_monthly_units', 'variation_coefficient', 'revenue_share', 'cumulative_revenue_share', 'stability_percentile'],
    'refreshed_product_monthly_sales': ['gross_revenue', 'discount_amount', 'revenue'],
    'rfm_profile': ['avg_recency_days', 'avg_frequency', 'avg_active_months', 'avg_sale_amount', 'avg_revenue_per_client', 'revenue', 'clients_pct', 'revenue_pct'],
    'rfm_study': ['revenue', 'avg_sale_amount'],
    'rows_per_day': [],
    'sales_dynamics': ['revenue', 'gross_revenue', 'discount_amount', 'avg_sale_amount'],
    'segment_breakdown': ['revenue', 'clients_pct', 'revenue_pct'],
    'top_products': ['revenue'],
    'validate_batches': [],
    'xyz_classic_counts': [],
    'xyz_profile': ['avg_monthly_units', 'std_monthly_units', 'cv'],
    'xyz_summary': ['cv_min', 'cv_median', 'cv_max', 'avg_monthly_units', 'products_pct'],
}
