"""Every registered query against its SQL oracle, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert mine
        return
    assert sorted(con.sql(sql).columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    assert mine == sorted(repr(r) for r in con.sql(f"SELECT {picked} FROM ({sql})").fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["url", "window_start_ms", "window_end_ms", "pv"]
