"""Distributed whole-table orders against plain single-partition windows."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.ranks import asc, desc, global_prefix
from tillroll.operators.stats import exact_percentiles


def _data(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if rnd.random() < 0.03 else rnd.choice([0, 0, 0, 1, 2, 3]) * 10 + rnd.randint(0, 3)
        rows.append((i, v, rnd.randint(-50, 50)))
    return spark.createDataFrame(rows, "id long, v int, x long")


def test_global_prefix_equals_window_with_ties_and_nulls(spark):
    df = _data(spark)
    keys = [desc("v", nulls_last=False), asc("id")]
    got = global_prefix(df, keys, ["x"], n_buckets=7)
    w = Window.orderBy(F.col("v").desc_nulls_first(), F.col("id").asc())
    exp = df.select("id", F.row_number().over(w).alias("rn"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    j = got.join(exp, "id")
    bad = j.where((F.col("row_no") != F.col("rn")) | (F.col("running_x") != F.col("run")))
    assert bad.count() == 0
    assert got.select(F.max("n_rows")).first()[0] == 3000
    assert got.select(F.max("total_x")).first()[0] == df.agg(F.sum("x")).first()[0]


def test_global_prefix_single_bucket_path(spark):
    df = _data(spark, 500, seed=5)
    a = {r.id: r.row_no for r in global_prefix(df, [asc("v"), asc("id")], [], n_buckets=1).collect()}
    b = {r.id: r.row_no for r in global_prefix(df, [asc("v"), asc("id")], [], n_buckets=9).collect()}
    assert a == b


def test_exact_percentiles_match_numpy(spark):
    rnd = random.Random(2)
    rows = [(g, rnd.randint(0, 1000) / 100) for g in ("a", "b", "c") for _ in range(rnd.randint(1, 400))]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("v", F.col("v").cast("decimal(10,2)"))
    pcts = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    got = {r.g: r for r in exact_percentiles(df, "v", pcts, ["g"], n_buckets=4).collect()}
    for g in ("a", "b", "c"):
        vals = np.array([float(v) for gg, v in rows if gg == g])
        for p in pcts:
            name = f"p{int(round(p * 100)):02d}"
            assert abs(float(getattr(got[g], name)) - np.percentile(vals, p * 100)) < 1e-9


def test_cume_counts_many_equal_cume_dist(spark):
    from tillroll.operators.ranks import cume_counts_many
    df = _data(spark, 1500, seed=13).withColumn("m", (F.col("x") * 3 + 7) % 11 / 4)
    n = df.count()
    got = cume_counts_many(df, ["v", "x", "m"], ["le_v", "le_x", "le_m"], n, n_buckets=6)
    exp = df.select("id", *[F.cume_dist().over(Window.orderBy(F.col(c).asc_nulls_last())).alias(f"cd_{c}")
                            for c in ("v", "x", "m")])
    j = got.join(exp, "id")
    for c in ("v", "x", "m"):
        bad = j.where(F.abs(F.col(f"le_{c}") / F.lit(n) - F.col(f"cd_{c}")) > 1e-12).count()
        assert bad == 0, c


def test_global_prefix_key_types_directions_nulls(spark):
    import datetime as dt
    from decimal import Decimal
    from tillroll.operators.ranks import Key
    rnd = random.Random(21)
    rows = []
    for i in range(2500):
        d = None if rnd.random() < 0.05 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        s = None if rnd.random() < 0.05 else rnd.choice(["a", "b", "bb", "c", "ä", "Z"])
        m = None if rnd.random() < 0.05 else Decimal(rnd.randint(-500, 500)) / 100
        rows.append((i, d, s, m, rnd.randint(0, 9)))
    df = spark.createDataFrame(rows, "id long, d date, s string, m decimal(10,2), x long")
    cases = [
        [Key("d", True, True), Key("s", False, False), Key("id", True)],
        [Key("m", False, True), Key("d", True, False), Key("id", False)],
        [Key("s", True, False), Key("m", True, True), Key("id", True)],
    ]
    for keys in cases:
        got = global_prefix(df, keys, ["x"], n_buckets=5)
        w = Window.orderBy(*[k.sort_col() for k in keys])
        exp = df.select("id", F.row_number().over(w).alias("rn"),
                        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
        bad = got.join(exp, "id").where((F.col("row_no") != F.col("rn")) | (F.col("running_x") != F.col("run")))
        assert bad.count() == 0, [(k.name, k.ascending, k.nulls_last) for k in keys]


def test_load_ids_contiguous_without_a_sort(spark):
    import datetime as dt
    from tillroll.session import staged
    from tillroll.sources.sales_table import load_units, with_load_columns
    place = F.floor(F.col("id") / 300).cast("long")
    rows = staged(spark.range(60000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("batch_date"),
        F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("file"),
        # JSON lines: a file read by two tasks; arrays: places from 0
        F.when(F.col("id") % 3 == 0, place + F.when(place >= 50, F.lit(1 << 33)).otherwise(0)).otherwise(place).alias("pos")))
    units = load_units(rows, 10)
    got = with_load_columns(rows, units, dt.datetime(2024, 1, 1))
    assert got.agg(F.min("sale_id"), F.max("sale_id"), F.count_distinct("sale_id")).first() == (10, 60009, 60000)
    w = Window.orderBy("batch_date", "file", "pos")
    exp = rows.select("batch_date", "file", "pos", (F.row_number().over(w) + 9).alias("exp_id"))
    assert got.join(exp, ["batch_date", "file", "pos"]).where(F.col("sale_id") != F.col("exp_id")).count() == 0
    assert "rangepartitioning" not in got._jdf.queryExecution().toString()
