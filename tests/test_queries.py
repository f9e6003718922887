import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload import queries as registered
from check_queries import TABLES, compare

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_equals_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, DATA)
    assert ok, note


def test_every_query_has_sql():
    assert set(registered.queries()) <= set(entry.queries()) & set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
