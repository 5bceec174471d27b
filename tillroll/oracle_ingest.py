"""DuckDB oracle SQL of the ingest queries: expected verdicts straight from
the defect rules of the derived records (no parsing)."""

from __future__ import annotations

from tillroll.oracle import (ABC_XYZ_CTES, CUSTOMER_RFM_CTES, DAILY_SALES_CTE, MART_SQL, MONTHLY_CTE,
                             PRODUCT_TOTALS_CTE, VARIABILITY_CTES, with_sales)
from tillroll.sources.fixture import BAD_NUMBER_MOD, CUT_FILE_DAY, NON_LIST_DAY, ODD_FILE_DAYS

RULES = """rules AS (
  SELECT purchase_date AS batch_date, client_id, product_id, quantity, total_price,
    dayofyear(purchase_date) = 100 AS no_gender,
    sale_id % 5003 = 0 AS bad_dt,
    sale_id % 3001 = 0 AND sale_id % 5003 <> 0 AS mismatch,
    sale_id % 2003 = 0 AS late,
    sale_id % 1009 = 0 OR sale_id % 7001 = 0 AS off_total,
    sale_id % 7001 = 0 OR dayofyear(purchase_date) = 100 AS bad_kind,
    sale_id % 7001 = 0 AS big_qty,
    sale_id % 1009 = 0 AS plus_cent
  FROM sales),
v0 AS (
  SELECT batch_date, count(*) AS rows,
    CASE WHEN bool_and(no_gender) THEN 'gender' ELSE '' END AS missing_columns,
    count(*) FILTER (WHERE bad_dt) AS bad_datetime,
    count(*) FILTER (WHERE false) AS bad_number,
    count(*) FILTER (WHERE mismatch) AS date_mismatch,
    count(*) FILTER (WHERE late) AS bad_time,
    count(*) FILTER (WHERE off_total) AS bad_total,
    count(*) FILTER (WHERE bad_kind) AS bad_type
  FROM rules GROUP BY batch_date),
v1 AS (
  SELECT *, CASE WHEN rows = 0 THEN 'empty' WHEN missing_columns <> '' THEN 'missing_columns'
    WHEN bad_datetime > 0 THEN 'bad_datetime' WHEN bad_number > 0 THEN 'bad_number'
    WHEN date_mismatch > 0 THEN 'date_mismatch' WHEN bad_time > 0 THEN 'bad_time'
    WHEN bad_total > 0 THEN 'bad_total' WHEN bad_type > 0 THEN 'bad_type' END AS reason
  FROM v0),
verdicts AS (
  SELECT *, CASE WHEN reason IS NULL THEN 'clean' ELSE 'failed' END AS status FROM v1)"""

STATUS = """cal AS (
  SELECT CAST(unnest(generate_series(min(purchase_date), max(purchase_date), INTERVAL 1 DAY)) AS DATE) AS batch_date
  FROM sales),
loaded AS (SELECT DISTINCT purchase_date FROM sales WHERE purchase_date < DATE '1996-01-01'),
status AS (
  SELECT c.batch_date,
    CASE WHEN l.purchase_date IS NOT NULL THEN 'skipped' WHEN v.status IS NULL THEN 'failed'
         WHEN v.status = 'clean' THEN 'loaded' ELSE 'failed' END AS status,
    CAST(CASE WHEN l.purchase_date IS NULL AND v.status = 'clean' THEN v.rows ELSE 0 END AS BIGINT) AS rows,
    CASE WHEN l.purchase_date IS NOT NULL THEN 'already_loaded' WHEN v.status IS NULL THEN 'empty'
         ELSE v.reason END AS reason
  FROM cal c LEFT JOIN loaded l ON l.purchase_date = c.batch_date
  LEFT JOIN verdicts v ON v.batch_date = c.batch_date)"""


def _dups(name: str, source: str, keys: str) -> str:
    return f"""SELECT '{name}' AS mart, (SELECT count(*) FROM {source}) AS rows,
  (SELECT count(*) FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_keys"""


INGEST_SQL = {
    "validate_batches": with_sales(RULES) + "SELECT * FROM verdicts",
    "landed_verdicts": with_sales(RULES) + "SELECT * FROM verdicts",
    "quarantine": with_sales(RULES) + """SELECT r.batch_date, CAST(r.client_id AS VARCHAR) AS client_id,
  CAST(r.product_id AS VARCHAR) AS product_id,
  CASE WHEN r.big_qty THEN '40000' ELSE CAST(r.quantity AS VARCHAR) END AS quantity,
  CAST(CAST(CASE WHEN r.plus_cent THEN r.total_price + 0.01 ELSE r.total_price END AS DECIMAL(16,2)) AS VARCHAR) AS total_price,
  r.bad_dt AS bad_datetime, false AS bad_number, r.mismatch AS date_mismatch, r.late AS bad_time,
  r.off_total AS bad_total, r.bad_kind AS bad_type
FROM rules r JOIN verdicts v ON v.batch_date = r.batch_date WHERE v.status = 'failed'""",
    "ingest_status": with_sales(RULES, STATUS) + "SELECT * FROM status",
    "backfill_summary": with_sales(RULES, STATUS) + """SELECT count(*) FILTER (WHERE status = 'loaded') AS loaded_days,
  count(*) FILTER (WHERE status = 'skipped') AS skipped_days,
  count(*) FILTER (WHERE status = 'failed') AS failed_days,
  CAST(COALESCE(sum(rows), 0) AS BIGINT) AS total_rows
FROM status""",
    "existing_dates": with_sales() + "SELECT DISTINCT purchase_date FROM sales",
    "key_contract": with_sales(DAILY_SALES_CTE, MONTHLY_CTE, CUSTOMER_RFM_CTES, PRODUCT_TOTALS_CTE,
                               VARIABILITY_CTES, ABC_XYZ_CTES) + "\nUNION ALL\n".join([
        _dups("daily_sales", "daily", "purchase_date"),
        _dups("product_monthly_sales", "monthly", "month_start, product_id"),
        _dups("customer_rfm", "customer_rfm", "client_id"),
        _dups("product_abc_xyz", "product_abc_xyz", "product_id"),
    ]),
}


NUMBERS = (RULES.replace("sale_id % 1009 = 0 OR sale_id % 7001 = 0 AS off_total", f"(sale_id % 1009 = 0 OR sale_id % 7001 = 0) AND sale_id % {BAD_NUMBER_MOD} <> 0 AS off_total")
           .replace("sale_id % 7001 = 0 OR dayofyear(purchase_date) = 100 AS bad_kind",
                    f"(sale_id % 7001 = 0 AND sale_id % {BAD_NUMBER_MOD} <> 0) OR dayofyear(purchase_date) = 100 AS bad_kind, sale_id % {BAD_NUMBER_MOD} = 0 AS no_number")
           .replace("FILTER (WHERE false)", "FILTER (WHERE no_number)"))
ODD_DAY = f"dayofyear(batch_date) % {ODD_FILE_DAYS}"
INGEST_SQL["quarantine_table"] = with_sales(NUMBERS) + f"""SELECT batch_date,
  CASE WHEN {ODD_DAY} = {NON_LIST_DAY} THEN 'not_a_list' WHEN {ODD_DAY} = {CUT_FILE_DAY} THEN 'broken_json' ELSE reason END AS reason,
  rows AS records, CASE WHEN {ODD_DAY} IN ({CUT_FILE_DAY}, {NON_LIST_DAY}) THEN 1 ELSE 0 END AS odd_files,
  bad_datetime, bad_number, date_mismatch, bad_time, bad_total, bad_type, product_sum
FROM verdicts JOIN (SELECT purchase_date AS batch_date, CAST(sum(product_id) AS BIGINT) AS product_sum FROM sales GROUP BY purchase_date) USING (batch_date)
WHERE dayofyear(batch_date) % 2 = 1 AND (reason IS NOT NULL OR {ODD_DAY} IN ({CUT_FILE_DAY}, {NON_LIST_DAY}))"""
INGEST_SQL["ingested_sales"] = with_sales() + f"""SELECT purchase_date, count(*) AS rows, count(*) AS ids, count(*) AS id_range,
  CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(client_id) AS BIGINT) AS client_sum, CAST(sum(product_id) AS BIGINT) AS product_sum,
  CAST(sum(total_price) AS DECIMAL(20,2)) AS revenue
FROM sales WHERE dayofyear(purchase_date) % {ODD_FILE_DAYS} NOT IN ({CUT_FILE_DAY}, {NON_LIST_DAY}) GROUP BY purchase_date"""
INGEST_SQL |= {f"refreshed_{name}": MART_SQL[name]
               for name in ("daily_sales", "customer_rfm", "product_monthly_sales", "product_abc_xyz")}
