"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
import __spark_entry__ as entrypoint  # noqa: E402
from pulsewright.catalog.oracles import all_oracles  # noqa: E402
from pulsewright.catalog.queries import all_queries  # noqa: E402
from tools.compare import TABLES, compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_each_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entrypoint.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, name, SF_DIR)
    assert ok, note


def test_entry(spark):
    df = entrypoint.entry(spark)
    assert len(df.columns) == 20 and df.count() > 0
