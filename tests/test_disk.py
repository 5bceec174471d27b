"""What large loads hold on disk: steps leave nothing behind, and much data goes through a run of dates or months at a time."""

import os

from pyspark.sql import functions as F
from test_ingest import day_rec, land

from tillroll import queries
from tillroll.plans import ingest
from tillroll.session import checkpoint_dir, freed_shuffles, in_parts, scratch, staged
from tillroll.sources import batches, fixture
from tillroll.sources.batches import read_day_batches
from tillroll.sources.sales_table import read_quarantine, read_sales


def _staged_tables(spark):
    return set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in files.mkString(",").split(",") if "/shuffle_" in n}


def test_runs_are_bounded_and_keep_their_order():
    assert in_parts({}, 5) == [] and in_parts({3: 1, None: 1, 1: 1}, 5) == [[None, 1, 3]]
    assert in_parts({1: 4, 2: 1, 3: 1, 4: 9, 5: 1}, 5) == [[1, 2], [3], [4], [5]]
    runs = in_parts(dict.fromkeys(range(1000), 10), 1)
    assert len(runs) <= 17 and sum(runs, []) == list(range(1000))


def test_a_staged_table_leaves_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k")
    before = _shuffle_files(spark)
    table = staged(df)
    with freed_shuffles(spark), freed_shuffles(spark):
        df.select("k").collect()
    assert not _shuffle_files(spark) - before and table.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_scratch_tables_go_and_kept_ones_stay(spark):
    before = _staged_tables(spark)
    with scratch(spark):
        with scratch(spark, kept=("kept",)):
            kept = staged(spark.range(3), "kept")
            staged(spark.range(3), "gone")
        assert kept.count() == 3 and {n[:4] for n in _staged_tables(spark) - before} == {"kept"}
    assert _staged_tables(spark) == before


def test_dates_are_ingested_in_runs_and_leave_their_status_only(spark, scratch, monkeypatch):
    days, got = [f"2024-02-0{i}" for i in range(1, 6)], []
    for at_once in (1 << 28, 1):
        landing, sales_path = f"{scratch}/landing-{at_once}", f"{scratch}/sales-{at_once}"
        monkeypatch.setattr(batches, "LANDED_AT_ONCE", at_once)
        for i, d in enumerate(days[:-1]):
            land(landing, d, '{"client_id": 4}' if i == 3 else [day_rec(d, client=c, total="9.00" if i == 2 else "20.00") for c in range(1, 4 + i)])
        ingest.ingest_dates(spark, landing, sales_path, days[1:2])
        land(landing, days[1], [day_rec(days[1], client=c) for c in (11, 12)], "part-1.json")
        before = _staged_tables(spark)
        status = ingest.ingest_dates(spark, landing, sales_path, days)
        left = {n.rpartition("-")[0] for n in _staged_tables(spark) - before}
        assert left == {"status"}, left
        again = ingest.ingest_dates(spark, landing, sales_path, days)
        got.append([sorted(map(str, df.collect())) for df in (
            status, again, read_sales(spark, sales_path).drop("loaded_at"), read_quarantine(spark, sales_path).drop("file"))])
    assert got[0] == got[1] and [len(x) for x in got[0]] == [5, 5, 3 + 6, 6]
    assert sum("status='loaded'" in x for x in got[0][0]) == 2 and sum("skipped" in x for x in got[0][1]) == 2


def _rows(spark, n):
    day = F.timestamp_seconds(F.unix_date(F.lit("1996-04-15").cast("date")).cast("bigint") * 86400 + F.col("id") % 4 * 86400)
    return spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 11).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(30.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.when(F.col("id") % 50 != 0, day).alias("o_orderdate"))


def test_sales_land_in_runs_as_they_do_at_once(spark, scratch, monkeypatch):
    rows, got = _rows(spark, 240), []
    for at_once in (10 ** 7, 1):
        root = f"{scratch}/landing-{at_once}"
        monkeypatch.setattr(fixture, "ROWS_AT_ONCE", at_once)
        monkeypatch.setattr(fixture, "RECORDS_PER_FILE", 50)
        parts = fixture.sales_in_parts(rows, F.expr("sale_id % 2 = 0"))
        assert len(parts) == (1 if at_once > 1 else 4) and sum(len(d) for d, _ in parts) == 4
        fixture.land_sales(parts, root, odd_files=True)
        fixture.land_sales(fixture.sales_in_parts(rows, F.expr("sale_id % 2 <> 0")), root, odd_files=True, append=True)
        fixture.land_sales(fixture.sales_in_parts(rows), root, lambda s: fixture.with_bad_numbers(fixture.fixture_records(spark, "", s)),
                           only=F.dayofyear("purchase_date") % 3 == 0, dates_only=True)
        records, files = read_day_batches(spark, root)
        got.append([sorted(map(str, x.collect())) for x in (
            records.select("batch_date", F.to_json("rec")), files.select("batch_date", "file_status"))])
    assert got[0] == got[1] and len(got[0][0]) == 235 and sum("broken" in x for x in got[0][1]) == 2  # of day 107 of the year


def test_distinct_ids_are_counted_without_a_shuffle_of_ids(spark):
    ids = [1, 2, 2, 63, 64, 64, 65, 10 ** 15, 10 ** 15 + 1]
    sales = spark.createDataFrame([(i,) for i in ids], "sale_id bigint").select(
        "sale_id", F.lit("2024-01-01").cast("date").alias("purchase_date"), F.lit(1).cast("smallint").alias("quantity"),
        F.lit(2).cast("bigint").alias("client_id"), F.lit(3).cast("bigint").alias("product_id"), F.lit("1.50").cast("decimal(16,2)").alias("total_price"))
    got = queries._loaded_totals(sales)
    r = got.first()
    assert (r.rows, r.ids, r.id_range, r.units, r.client_sum, r.product_sum, str(r.revenue)) == (9, 7, 10 ** 15 + 1, 9, 18, 27, "13.50")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "sale_id" in x]
