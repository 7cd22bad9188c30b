"""Every registered query against its SQL twin in DuckDB."""

import importlib
from pathlib import Path

import duckdb
import pytest

SF_DIR = Path("/root/testdata/sf0.001")
entry = importlib.import_module("__spark_entry__")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(entry.catalog.QUERIES) == set(entry.catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.catalog.QUERIES))
def test_query_equals_twin(spark, duck, name):
    df = entry.queries()[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    twin = duck.sql(entry.oracle_sql()[name])
    assert columns == sorted(twin.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    want = sorted(twin.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall(), key=repr)
    assert got == want
