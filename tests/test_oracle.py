"""Every query with a SQL form gives the same rows in Spark and in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _table(arrow):
    names = sorted(arrow.column_names)
    types = {f.name: str(f.type).replace("large_", "") for f in arrow.schema}
    return names, types, sorted(repr(tuple(r[n] for n in names)) for r in arrow.to_pylist())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    names, types, found = _table(QUERIES[name](spark, SF_DIR).toArrow())
    sql_names, sql_types, expected = _table(duck.sql(ORACLE[name]).to_arrow_table())
    assert names == sql_names
    assert types == sql_types
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
