"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402
from tillroll.oracle import all_sql  # noqa: E402
from tillroll.queries import all_queries  # noqa: E402

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "date": "DATE",
         "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows, s_cols = rows_of(df.columns, df.collect())
    cur = con.execute(E.oracle_sql()[name])
    d_rows, d_cols = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert sorted(s_rows, key=str) == sorted(d_rows, key=str)
    # same column types on both sides (decimals are handed over as DOUBLE)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "abc_xyz_class" in df.columns
