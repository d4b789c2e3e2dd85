"""Every registered query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from helixframe.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(round(float(v), 6))
    return str(v)


def _rows(df):
    names = sorted(df.columns)
    return sorted(tuple(_cell(v) for v in r) for r in df[names].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    mine, theirs = QUERIES[name](spark, FOLDER).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert _rows(mine) == _rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() >= 0
