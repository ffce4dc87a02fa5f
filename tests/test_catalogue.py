"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import compare
from wardlight.sources.adapter import TABLES

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    verdict = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert not verdict.startswith("FAIL"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0
