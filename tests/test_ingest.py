"""Landed day batches: one date per rule (negative fixtures), then the
end-to-end ingest: skip / load / fail, idempotent reruns, contiguous ids."""

import json
import os

from pyspark.sql import functions as F

from tillroll.plans.ingest import daily_load, ingest_dates, run_summary
from tillroll.plans.marts import MART_ORDER
from tillroll.sources.batches import read_day_batches, validate_batches
from tillroll.sources.sales_table import assert_unique, read_sales


def rec(client=1, gender="M", dt="2024-01-06 10:00:00", t=36000, product=7, qty=2, price="10.50",
        disc="0.50", total="20.00", drop=()):
    r = {"client_id": client, "gender": gender, "purchase_datetime": dt,
         "purchase_time_as_seconds_from_midnight": t, "product_id": product, "quantity": qty,
         "price_per_item": price, "discount_per_item": disc, "total_price": total}
    for k in drop:
        r.pop(k)
    return r


def land(root, day, payload, name="part-0.json"):
    local = root[len("file:"):] if root.startswith("file:") else root
    d = os.path.join(local, f"batch_date={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


def day_rec(day, **kw):
    return rec(dt=f"{day} 10:00:00", **kw)


CASES = {
    "2024-01-01": ('{"client_id": 1}', "not_a_list"),
    "2024-01-02": ('[{"client_id": 1,', "broken_json"),
    "2024-01-03": ("[]", "empty"),
    "2024-01-04": ([day_rec("2024-01-04", drop=("gender",)), day_rec("2024-01-04", drop=("gender",))],
                   "missing_columns"),
    "2024-01-05": ([day_rec("2024-01-05", gender=None)], "bad_type"),
    "2024-01-06": ([day_rec("2024-01-06"), day_rec("2024-01-06", client=2, gender="F")], None),
    "2024-01-07": ([rec(dt="2024-13-45")], "bad_datetime"),
    "2024-01-08": ([day_rec("2024-01-08"), day_rec("2024-01-09")], "date_mismatch"),
    "2024-01-09": ([day_rec("2024-01-09", t=86399), day_rec("2024-01-09", t=86400)], "bad_time"),
    "2024-01-10": ([day_rec("2024-01-10", t=-1)], "bad_time"),
    "2024-01-11": ([day_rec("2024-01-11", total="20.01")], "bad_total"),
    "2024-01-12": ([day_rec("2024-01-12", qty="3.7", total="30.00")], None),
    "2024-01-13": ([day_rec("2024-01-13", qty=40000, total="400000.00")], "bad_type"),
    "2024-01-14": ([day_rec("2024-01-14", gender="MF")], "bad_type"),
    "2024-01-15": ([day_rec("2024-01-15", qty="abc")], "bad_number"),
}


def test_verdict_per_rule(spark, scratch):
    landing = f"{scratch}/landing"
    for day, (payload, _) in CASES.items():
        land(landing, day, payload)
    records, files = read_day_batches(spark, landing)
    clean, quarantine, verdicts = validate_batches(records, files)
    got = {str(r.batch_date): r for r in verdicts.collect()}
    for day, (_, reason) in CASES.items():
        assert got[day].reason == reason, (day, got[day])
        assert got[day].status == ("clean" if reason is None else "failed")
    assert got["2024-01-04"].missing_columns == "gender"
    assert got["2024-01-09"].bad_time == 1
    # "3.7" truncates to 3 like an int64 cast of a float
    q = clean.where(F.col("batch_date") == "2024-01-12").select("quantity").first()[0]
    assert q == 3
    assert clean.count() == 3
    assert quarantine.where(F.col("batch_date") == "2024-01-11").count() == 1


def test_ingest_skip_load_fail_and_rerun(spark, scratch):
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    land(landing, "2024-02-01", [day_rec("2024-02-01"), day_rec("2024-02-01", client=3)])
    land(landing, "2024-02-02", [day_rec("2024-02-02", client=4), day_rec("2024-02-02", product=9)])
    land(landing, "2024-02-03", [day_rec("2024-02-03", total="1.00")])
    first = {str(r.batch_date): r.status for r in ingest_dates(spark, landing, sales_path, ["2024-02-01"]).collect()}
    assert first == {"2024-02-01": "loaded"}
    st = ingest_dates(spark, landing, sales_path, ["2024-02-01", "2024-02-02", "2024-02-03", "2024-02-04"])
    got = {str(r.batch_date): (r.status, r.reason, r.rows) for r in st.collect()}
    assert got["2024-02-01"] == ("skipped", "already_loaded", 0)
    assert got["2024-02-02"] == ("loaded", None, 2)
    assert got["2024-02-03"] == ("failed", "bad_total", 0)
    assert got["2024-02-04"] == ("failed", "empty", 0)
    summary = run_summary(st).first()
    assert (summary.loaded_days, summary.skipped_days, summary.failed_days, summary.total_rows) == (1, 1, 2, 2)
    sales = read_sales(spark, sales_path)
    assert sales.count() == 4
    ids = sorted(r.sale_id for r in sales.select("sale_id").collect())
    assert ids == [1, 2, 3, 4]
    # a rerun adds nothing
    again = ingest_dates(spark, landing, sales_path, ["2024-02-01", "2024-02-02"])
    assert {r.status for r in again.collect()} == {"skipped"}
    assert read_sales(spark, sales_path).count() == 4


def test_daily_load_refreshes_marts(spark, scratch):
    landing, sales_path, marts = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    for d in ("2024-03-30", "2024-03-31", "2024-04-01"):
        land(landing, d, [day_rec(d, client=c, product=p) for c in (1, 2) for p in (5, 6)])
    ingest_dates(spark, landing, sales_path, ["2024-03-30", "2024-03-31"])
    st = daily_load(spark, landing, sales_path, "2024-04-02", marts)
    assert [r.status for r in st.collect()] == ["loaded"]
    daily = spark.read.parquet(f"{marts}/daily_sales")
    assert daily.count() == 3
    # skipped day: the marts are refreshed anyway and stay the same
    st = daily_load(spark, landing, sales_path, "2024-04-02", marts)
    assert [r.status for r in st.collect()] == ["skipped"]
    assert spark.read.parquet(f"{marts}/daily_sales").count() == 3
    keys = {"daily_sales": ["purchase_date"], "product_monthly_sales": ["month_start", "product_id"],
            "customer_rfm": ["client_id"], "product_abc_xyz": ["product_id"]}
    for name in MART_ORDER:
        assert assert_unique(spark.read.parquet(f"{marts}/{name}"), keys[name]).count() == 0
    # two months (March, April): one complete month before the last -> every product ranked
    assert spark.read.parquet(f"{marts}/product_abc_xyz").count() == 2


def test_cli_backfill_and_refresh(spark, scratch, capsys):
    from tillroll.__main__ import main
    landing, sales_path, marts = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    for d in ("2024-07-01", "2024-07-02", "2024-08-01"):
        land(landing, d, [day_rec(d, client=c) for c in (1, 2, 3)])
    main(["backfill", "--landing", landing, "--sales", sales_path, "--start", "2024-07-01", "--end", "2024-07-03"])
    assert read_sales(spark, sales_path).count() == 6
    main(["daily", "--landing", landing, "--sales", sales_path, "--marts", marts, "--as-of", "2024-08-02"])
    assert read_sales(spark, sales_path).count() == 9
    main(["refresh", "--sales", sales_path, "--marts", marts, "--months", "2024-08-01"])
    assert spark.read.parquet(f"{marts}/daily_sales").count() == 3
    out = capsys.readouterr().out
    assert "loaded_days" in out


def _marts_equal_recompute(spark, sales_path, marts):
    from tillroll.plans import marts as M
    sales = read_sales(spark, sales_path)
    monthly = M.product_monthly_sales(sales)
    full = {"daily_sales": M.daily_sales(sales), "product_monthly_sales": monthly, "customer_rfm": M.customer_rfm(sales),
            "product_abc_xyz": M.product_abc_xyz(monthly)}
    for name, want in full.items():
        cols = sorted(want.columns)
        got = spark.read.parquet(f"{marts}/{name}").select(*cols)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*cols).collect())), name


def test_marts_equal_full_recompute_after_gaps(spark, scratch):
    landing, sales_path, marts = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    days = ["2024-08-31", "2024-09-01", "2024-09-02", "2024-09-03", "2024-10-01"]
    for i, d in enumerate(days):
        land(landing, d, [day_rec(d, client=c, gender="MF"[c % 2], total=f"{20 * (i + 1)}.00",
                                  price=f"{10 * (i + 1) + 0.25:.2f}", disc="0.25") for c in range(1 + i, 6 + i)])
    ingest_dates(spark, landing, sales_path, [days[1]])
    daily_load(spark, landing, sales_path, "2024-09-02", marts)   # first build: 09-01
    # dates of two months loaded without a refresh, as after a backfill or a crash behind the append
    ingest_dates(spark, landing, sales_path, [days[0], days[2], days[3]])
    daily_load(spark, landing, sales_path, "2024-10-02", marts)
    assert spark.read.parquet(f"{marts}/daily_sales").count() == 5
    _marts_equal_recompute(spark, sales_path, marts)
    # only new dates: the client state is merged
    land(landing, "2024-10-02", [day_rec("2024-10-02", client=c, total="20.00") for c in (2, 9)])
    daily_load(spark, landing, sales_path, "2024-10-03", marts)
    _marts_equal_recompute(spark, sales_path, marts)
    # a file that lands late replaces its date, also in the marts
    land(landing, "2024-09-02", [day_rec("2024-09-02", client=77)], "part-1.json")
    st = ingest_dates(spark, landing, sales_path, ["2024-09-02"]).first()
    assert (st.status, st.rows) == ("loaded", 6)
    daily_load(spark, landing, sales_path, "2024-10-03", marts)
    _marts_equal_recompute(spark, sales_path, marts)


def test_bodies_that_are_not_one_whole_array(spark, scratch):
    landing = f"{scratch}/landing"
    one = json.dumps(day_rec("2024-01-01"))
    bodies = {"[%s]garbage": "broken_json", "[%s][%s,%s": "broken_json", "[%s,%s], %s": "broken_json",
              '[%s],"x":[2]': "broken_json", "[%s],1] [": "broken_json", "[%s,\n  %s\n]\n": None, " [ %s ] ": None}
    for i, body in enumerate(bodies):
        land(landing, f"2024-01-{i + 1:02}", body.replace("%s", one.replace("2024-01-01", f"2024-01-{i + 1:02}")))
    v = {r.batch_date.day: r for r in validate_batches(*read_day_batches(spark, landing))[2].collect()}
    for i, (body, reason) in enumerate(bodies.items()):
        assert v[i + 1].reason == reason, (body, v[i + 1])
    assert v[6].rows == 2


def test_types_zones_and_pretty_printed_files(spark, scratch):
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    land(landing, "2024-01-01", [day_rec("2024-01-01", client=3000000000)])       # beyond INTEGER
    land(landing, "2024-01-02", [rec(dt="2024-01-02T01:00:00+03:00"), day_rec("2024-01-02", client="5.0")])
    land(landing, "2024-01-03", json.dumps([day_rec("2024-01-03"), day_rec("2024-01-03", client=2)], indent=2))
    land(landing, "2024-01-04", [day_rec("2024-01-04", client="5.5")])
    got = {r.batch_date.day: (r.status, r.reason) for r in
           ingest_dates(spark, landing, sales_path, [f"2024-01-0{i}" for i in (1, 2, 3, 4)]).collect()}
    assert got == {1: ("failed", "bad_type"), 2: ("loaded", None), 3: ("loaded", None), 4: ("failed", "bad_type")}
    assert read_sales(spark, sales_path).count() == 4


def test_ids_go_on_without_a_load_log(spark, scratch):
    import tillroll.sources.sales_table as st
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    for d in ("2024-11-01", "2024-11-02", "2024-11-03"):
        land(landing, d, [day_rec(d, client=c) for c in (1, 2)])
    ingest_dates(spark, landing, sales_path, ["2024-11-01"])
    log = st.read_log(spark, st.load_log_path(sales_path), st.LOAD_LOG_SCHEMA)
    log.limit(0).write.mode("overwrite").parquet(st.load_log_path(sales_path))   # there, but empty
    ingest_dates(spark, landing, sales_path, ["2024-11-02"])
    ingest_dates(spark, landing, sales_path, ["2024-11-03"])
    assert sorted(r.sale_id for r in read_sales(spark, sales_path).collect()) == [1, 2, 3, 4, 5, 6]
    assert st.table_exists(spark, sales_path) and st.table_exists(spark, sales_path.removeprefix("file:"))
    assert not st.table_exists(spark, f"{scratch}/nothing")


def test_stored_types(spark, scratch):
    landing, sales_path, marts = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    land(landing, "2024-12-01", [day_rec("2024-12-01")])
    daily_load(spark, landing, sales_path, "2024-12-02", marts)
    types = {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{marts}/daily_sales").schema}
    assert types["revenue"] == "decimal(20,2)" and types["weighted_discount_pct"] == "decimal(8,2)"
    types = {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{marts}/product_abc_xyz").schema}
    assert types["variation_coefficient"] == "decimal(12,4)" and types["revenue_share"] == "decimal(12,8)"


def test_command_line_keeps_submitted_settings(tmp_path):
    import subprocess
    import sys
    code = ("from tillroll.session import submitted_session as s; c = s(); "
            "print('GOT', c.sparkContext.master, c.conf.get('spark.sql.shuffle.partitions'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=777 --conf spark.ui.enabled=false pyspark-shell"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 777" in out.stdout, out.stderr[-500:]


def test_marts_as_sql_views(spark, scratch):
    from tillroll.plans.views import register_views
    landing, sales_path, marts = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    for d in ("2024-12-01", "2024-12-02"):
        land(landing, d, [day_rec(d, client=c, product=p) for c in (1, 2) for p in (5, 6)])
    ingest_dates(spark, landing, sales_path, ["2024-12-01"])
    daily_load(spark, landing, sales_path, "2024-12-03", marts)
    names = register_views(spark, marts, sales_path, prefix="t_")
    assert "t_customer_rfm" in names and "t_sales" in names
    got = spark.sql("""SELECT sum(revenue) AS r, sum(sales_count) AS n FROM t_daily_sales
                       WHERE purchase_date BETWEEN DATE '2024-12-01' AND DATE '2024-12-31'""").first()
    assert got.n == 8 and got.r == spark.sql("SELECT sum(total_price) AS t FROM t_sales").first().t
