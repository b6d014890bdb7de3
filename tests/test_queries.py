"""Registered queries against their SQL in DuckDB, over the smallest tables."""

import glob
import os

import duckdb
import pytest

from tilelake.plans import catalog

DIR = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([v[i] for i in order]) for v in values)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DIR)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got[1]
        return
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert got == rows(columns, want.fetchall())
