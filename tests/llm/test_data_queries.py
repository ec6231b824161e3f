"""The registered queries: against their SQL where there is one, on odd tables where there is none."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from quern.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_sql(spark, con, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = con.execute(queries.ORACLES[name])
    names = [c[0] for c in result.description]
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=_key)
    assert sorted(names) == columns and sorted((tuple(r) for r in df.select(*columns).collect()), key=_key) == want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    """Every query over tables without rows gives none and does not fail."""
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        spark.read.parquet(path).limit(0).write.parquet(str(tmp_path / os.path.basename(path)))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_registered():
    assert set(queries.QUERIES) <= set(driver.queries()) and {f"p{n}_{'ids' if n == 8 else 'found'}" for n in range(1, 11)} <= set(queries.QUERIES)
