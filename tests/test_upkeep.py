"""Upkeep of the stored tables: ids under several loaders, reads by date folder, the quarantine table, month partials and
id sets."""

import json
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from test_ingest import _marts_equal_recompute, day_rec, land

from tillroll.plans import dashboard, marts
from tillroll.plans.ingest import daily_load, ingest_dates
from tillroll.sources import ids
from tillroll.sources.batches import date_folders, landed_files, read_day_batches
from tillroll.sources.sales_table import append_sales, date_versions, read_quarantine, read_sales


def _local(path):
    return path.removeprefix("file:")


# ---- ids ------------------------------------------------------------------------------------------------------------

def test_claims_follow_one_another(spark, scratch, monkeypatch):
    path = f"{scratch}/sales"
    assert [ids.claim_ids(spark, path, n) for n in (5, 1, 10)] == [1, 6, 7]
    assert ids.claim_ids(spark, f"{path}2", 3, lambda: 100) == 100 and ids.claim_ids(spark, f"{path}2", 3, lambda: 500) == 103
    monkeypatch.setattr(ids, "KEPT_SECONDS", -60)
    assert ids.claim_ids(spark, path, 1) == 17
    assert len([n for n in os.listdir(_local(ids.ids_path(path))) if n[0] != "."]) == 1  # the highest claim
    assert ids.claim_ids(spark, path, 1) == 18


def test_loaders_that_see_the_same_state_get_disjoint_ranges(spark, scratch, monkeypatch):
    path, plain, calls = f"{scratch}/sales", ids._claims, []

    def blind_at_first(fs, root):
        calls.append(1)
        return {} if len(calls) in (1, 3) else plain(fs, root)  # the first look of both loaders sees nothing
    monkeypatch.setattr(ids, "_claims", blind_at_first)
    assert ids.claim_ids(spark, path, 10) == 1
    assert ids.claim_ids(spark, path, 10) == 11  # sees the other's claim when it lists again, and withdraws its own


def test_many_loaders_at_once(spark, scratch, monkeypatch):
    monkeypatch.setattr(ids, "LONGEST_PAUSE", 0.05)
    sizes = [3, 1, 7, 2, 9, 4, 4, 1]
    with ThreadPoolExecutor(len(sizes)) as pool:
        firsts = list(pool.map(lambda n: ids.claim_ids(spark, f"{scratch}/sales", n), sizes))
    dealt = [i for first, n in zip(firsts, sizes) for i in range(first, first + n)]
    assert len(set(dealt)) == len(dealt) == sum(sizes)


def test_two_ingests_from_one_state(spark, scratch):
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    days = [f"2024-02-0{i}" for i in range(1, 7)]
    for d in days:
        land(landing, d, [day_rec(d, client=c) for c in range(1, 6)])
    ingest_dates(spark, landing, sales_path, days[:1])
    with ThreadPoolExecutor(2) as pool:
        for status in pool.map(lambda some: ingest_dates(spark, landing, sales_path, some).collect(), (days[1:3], days[3:])):
            assert {r.status for r in status} == {"loaded"}
    sales = read_sales(spark, sales_path)
    assert sales.count() == 30 == sales.select("sale_id").distinct().count()


# ---- reads by date folder -------------------------------------------------------------------------------------------

def test_only_the_wanted_folders_are_read(spark, scratch):
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    for d in ("2024-03-01", "2024-03-02", "2024-03-03"):
        land(landing, d, [day_rec(d)])
    # a listing of the root would fail on this folder
    os.makedirs(f"{_local(landing)}/batch_date=2024-03-04/other=1")
    land(landing, "2024-03-04/other=1", "[]")
    os.makedirs(f"{_local(landing)}/elsewhere=5")
    land(f"{landing}/elsewhere=5", "2024-03-05", "[]")
    assert [p.rpartition("=")[2] for p in date_folders(spark, landing, ["2024-03-02", "2024-03-09", "2024-03-02"])] == ["2024-03-02"]
    status = ingest_dates(spark, landing, sales_path, ["2024-03-02"]).first()
    assert (status.status, status.rows, status.landed_rows) == ("loaded", 1, 1)
    land(landing, "2024-03-02", [day_rec("2024-03-02", client=2)], "part-1.json")  # and late files are looked for in it
    assert landed_files(spark, landing, ["2024-03-02"]).count() == 2
    assert ingest_dates(spark, landing, sales_path, ["2024-03-02"]).first().rows == 2


def test_folders_of_no_or_many_dates(spark, scratch):
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    days = [f"2024-{m:02}-{d:02}" for m in range(1, 5) for d in range(1, 29)]
    assert date_folders(spark, landing, days) == [] == date_folders(spark, landing, days[:3])
    assert {(r.status, r.reason) for r in ingest_dates(spark, landing, sales_path, days[:3]).collect()} == {("failed", "empty")}
    for d in days[::3]:
        land(landing, d, [day_rec(d)])
    assert date_folders(spark, landing, days) == [f"{landing}/batch_date={d}" for d in days[::3]]
    records, files = read_day_batches(spark, landing, days[:10])
    assert records.count() == 4 == files.count()


# ---- quarantine -----------------------------------------------------------------------------------------------------

def _letters(spark, sales_path):
    return sorted((str(r.batch_date), r.reason, r.file_status, r.record and json.loads(r.record).get("client_id"))
                  for r in read_quarantine(spark, sales_path).collect())


def test_failed_dates_are_kept_and_replaced(spark, scratch):
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    days = ["2024-04-01", "2024-04-02", "2024-04-03", "2024-04-04"]
    land(landing, days[0], [day_rec(days[0])])
    land(landing, days[1], [day_rec(days[1]), day_rec(days[1], client=2, qty="n/a"), day_rec(days[1], client=3, total="1.00", gender="XY")])
    land(landing, days[2], '{"client_id": 4}')
    assert read_quarantine(spark, sales_path).count() == 0
    got = {str(r.batch_date): r for r in ingest_dates(spark, landing, sales_path, days).collect()}
    bad = got[days[1]]
    assert (bad.status, bad.reason, bad.rows, bad.landed_rows, bad.bad_number, bad.bad_total, bad.bad_type) == ("failed", "bad_number", 0, 3, 1, 1, 1)
    assert (got[days[0]].landed_rows, got[days[0]].bad_number, got[days[3]].reason, got[days[3]].landed_rows) == (1, 0, "empty", 0)
    assert _letters(spark, sales_path) == [(days[1], "bad_number", "ok", c) for c in "123"] + [(days[2], "not_a_list", "not_a_list", None)]
    flags = {json.loads(r.record)["client_id"]: (r.bad_number, r.bad_total, r.bad_type) for r in read_quarantine(spark, sales_path).where("record is not null").collect()}
    assert flags == {"1": (False, False, False), "2": (True, False, False), "3": (False, True, True)}
    # the date fails again with other rows; another is mended; the letters of dates that are not asked for stay
    land(landing, days[1], [day_rec(days[1], client=9, total="2.00")])
    assert ingest_dates(spark, landing, sales_path, days[1:2]).first().reason == "bad_total"
    assert _letters(spark, sales_path) == [(days[1], "bad_total", "ok", "9"), (days[2], "not_a_list", "not_a_list", None)]
    land(landing, days[2], [day_rec(days[2])])
    land(landing, days[1], [day_rec(days[1])])
    assert {r.status for r in ingest_dates(spark, landing, sales_path, days[1:3]).collect()} == {"loaded"}
    assert _letters(spark, sales_path) == [] and read_sales(spark, sales_path).count() == 3


# ---- month partials and id sets -------------------------------------------------------------------------------------

def test_a_replaced_date_reads_only_its_month(spark, scratch):
    landing, sales_path, out = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    days = ["2024-05-30", "2024-05-31", "2024-06-01", "2024-07-01"]
    for i, d in enumerate(days):
        land(landing, d, [day_rec(d, client=c, gender="MF"[(c + i) % 2]) for c in range(1 + i, 6)])
    ingest_dates(spark, landing, sales_path, days)
    daily_load(spark, landing, sales_path, "2024-07-02", out)
    _marts_equal_recompute(spark, sales_path, out)
    # the date loses its first and only sale of client 1's minimum date and gains another client
    os.remove(f"{_local(landing)}/batch_date={days[1]}/part-0.json")
    land(landing, days[1], [day_rec(days[1], client=c) for c in (4, 50)], "part-1.json")
    assert ingest_dates(spark, landing, sales_path, [days[1]]).first().status == "loaded"
    hidden = [f"{_local(sales_path)}/purchase_date={d}" for d in days[2:]]
    kept = {}
    for folder in hidden:  # other months' sales can't be read now
        for name in [n for n in os.listdir(folder) if n.endswith(".parquet")]:
            kept[f"{folder}/{name}"] = open(f"{folder}/{name}", "rb").read()
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"not parquet")
            if os.path.exists(f"{folder}/.{name}.crc"):
                kept[f"{folder}/.{name}.crc"] = open(f"{folder}/.{name}.crc", "rb").read()
                os.remove(f"{folder}/.{name}.crc")
    marts.refresh_marts(read_sales(spark, sales_path), out, ["customer_rfm", "daily_sales"], versions=date_versions(spark, sales_path))
    for path, content in kept.items():
        with open(path, "wb") as f:
            f.write(content)
    spark.catalog.refreshByPath(sales_path)
    daily_load(spark, landing, sales_path, "2024-07-02", out)
    _marts_equal_recompute(spark, sales_path, out)


def _sales_of(spark, rows):
    return spark.createDataFrame(
        [(i, c, "M", d, 1, p, 1, "2.00", "0.00", "2.00") for i, (d, c, p) in enumerate(rows)],
        "sale_id long, client_id int, gender string, d string, purchase_time_seconds int, product_id int, quantity short, p string, q string, t string",
    ).select("sale_id", "client_id", "gender", F.to_date("d").alias("purchase_date"), "purchase_time_seconds", "product_id", "quantity",
             F.col("p").cast("decimal(14,2)").alias("price_per_item"), F.col("q").cast("decimal(14,2)").alias("discount_per_item"),
             F.col("t").cast("decimal(16,2)").alias("total_price"))


def test_id_sets_count_any_ids(spark):
    odd = [0, 1, 63, 64, 65, -1, -64, -65, 2 ** 31 - 1, -2 ** 31]
    rows = [(d, c, p) for d in ("2024-01-31", "2024-02-01") for k, c in enumerate(odd) for p in (c, odd[k - 1]) if k % 3 or d < "2024-02"]
    sales = _sales_of(spark, rows)
    daily, presence = marts.daily_sales(sales), marts.daily_presence(sales)
    got = {str(r.purchase_date): (r.unique_clients, r.unique_products, r.sales_count) for r in daily.collect()}
    want = {d: (len({c for x, c, _ in rows if x == d}), len({p for x, _, p in rows if x == d}), sum(x == d for x, _, _ in rows)) for d in {x for x, _, _ in rows}}
    assert got == want
    k = dashboard.kpis(daily, presence, "2024-01-01", "2024-12-31").first()
    assert (k.unique_clients, k.sales_count) == (10, len(rows))
    assert {r.active_clients for r in dashboard.client_activity(daily, presence, "year").collect()} == {10}
    none = dashboard.kpis(daily, presence, "2025-01-01", "2025-12-31").first()
    assert (none.unique_clients, none.sales_count, none.units_sold, none.avg_sale_amount) == (0, 0, 0, None)


def test_daily_plan_has_no_expand(spark):
    sales = _sales_of(spark, [("2024-01-01", 1, 2)])
    plan = marts.daily_sales(sales)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "unique_clients" in plan
    daily, presence = marts.daily_sales(sales), marts.daily_presence(sales)
    for df in (dashboard.kpis(daily, presence, "2024-01-01", "2024-01-02"), dashboard.client_activity(daily, presence)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_stored_id_sets_serve_the_dashboard(spark, scratch):
    landing, sales_path, out = f"{scratch}/landing", f"{scratch}/sales", f"{scratch}/marts"
    days = ["2024-08-30", "2024-08-31", "2024-09-01"]
    for i, d in enumerate(days):
        land(landing, d, [day_rec(d, client=c) for c in range(1 + i, 4 + i)])
    ingest_dates(spark, landing, sales_path, days)
    daily_load(spark, landing, sales_path, "2024-09-02", out)
    daily, presence = spark.read.parquet(f"{out}/daily_sales"), spark.read.parquet(f"{out}/{marts.PRESENCE}")
    got = {str(r.period_start): (r.active_clients, r.sales_count) for r in dashboard.client_activity(daily, presence).collect()}
    assert got == {"2024-08-01": (4, 6), "2024-09-01": (3, 3)}
    assert dashboard.kpis(daily, presence, "2024-08-31", "2024-09-01").first().unique_clients == 4


# ---- percentiles by selection ---------------------------------------------------------------------------------------

def test_selection_narrows_any_distribution(spark):
    import random
    from decimal import Decimal

    import numpy as np

    from tillroll.operators.stats import exact_percentiles
    rnd = random.Random(8)
    groups = {"same": [5] * 50, "one": [7], "two": [1, 10 ** 12], "ties": [rnd.choice([1, 2, 3]) for _ in range(200)],
              "tail": [int(10 ** rnd.uniform(0, 14)) for _ in range(300)], "below": [-rnd.randint(0, 10 ** 6) for _ in range(99)],
              "hot": [42] * 500 + list(range(250))}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), (None, 3), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long").withColumn("v", F.col("v").cast("decimal(20,2)"))
    pcts = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    names = [f"q{i}" for i in range(len(pcts))]
    for bins in (16, None):
        got = {r.g: r for r in exact_percentiles(df, "v", pcts, ["g"], names, n_buckets=bins).collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            vs = sorted(map(Decimal, vs))
            for p, name in zip(pcts, names):
                pos = (len(vs) - 1) * Decimal(str(p))
                lo = int(pos)
                want = vs[lo] + (vs[min(lo + 1, len(vs) - 1)] - vs[lo]) * (pos - lo)
                assert getattr(got[g], name) == want, (g, p)
    doubles = spark.createDataFrame([(x,) for x in np.random.default_rng(1).lognormal(0, 9, 400).tolist()], "v double")
    r = exact_percentiles(doubles, "v", [0.5]).first()
    assert abs(r.p50 / np.median([x.v for x in doubles.collect()]) - 1) < 1e-12
    assert exact_percentiles(doubles.limit(0), "v", [0.5]).collect()[0].p50 is None
    assert exact_percentiles(df.limit(0), "v", [0.5], ["g"]).count() == 0


def test_selection_sorts_nothing_by_range(spark, monkeypatch):
    from tillroll.operators import stats
    plans, plain = [], stats.staged

    def seen(df, tag="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, tag)
    monkeypatch.setattr(stats, "staged", seen)
    stats.exact_percentiles(spark.range(5000).withColumn("v", F.col("id").cast("decimal(20,2)")), "v", [0.1, 0.5]).collect()
    assert len(plans) >= 3 and not any("rangepartitioning" in p for p in plans)


# ---- counts taken while writing -------------------------------------------------------------------------------------

def test_overview_from_the_load_log(spark, scratch):
    from tillroll.plans.coverage import load_overview, logged_overview
    landing, sales_path = f"{scratch}/landing", f"{scratch}/sales"
    days = ["2024-10-01", "2024-10-02", "2024-10-05"]
    assert tuple(logged_overview(spark, sales_path).first()) == (None, None, 0, 0)
    for i, d in enumerate(days):
        land(landing, d, [day_rec(d, client=c) for c in range(1, 3 + i)])
    ingest_dates(spark, landing, sales_path, days)
    land(landing, days[0], [day_rec(days[0], client=9)], "part-1.json")  # loaded again: its last count holds
    ingest_dates(spark, landing, sales_path, days)
    want = load_overview(read_sales(spark, sales_path)).first()
    assert logged_overview(spark, sales_path).first() == want and want.total_rows == 10
    append_sales(_sales_of(spark, [("2024-11-01", 1, 1)]).withColumn("loaded_at", F.current_timestamp()), sales_path)  # not logged
    assert logged_overview(spark, sales_path).first().total_rows == 11
