"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{FOLDER}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return c


def cell(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and np.isnan(x)):
        return "NULL"
    return f"{float(x):.5f}" if isinstance(x, (float, np.floating)) else str(x)


def rows(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 200
