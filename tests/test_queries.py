"""Every registered core query against its SQL, and the driver's contract."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from quern.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_agrees_with_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    result = con.execute(catalogue.ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=_key)
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 4
    assert set(driver.oracle_sql()) <= set(driver.queries())
