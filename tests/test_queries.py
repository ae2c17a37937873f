"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive value hash), plus the driver
contract of ``__spark_entry__``."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest
from silverline.sources.tables import TABLES

SF = os.environ.get("SILVERLINE_TEST_SF", "/root/testdata/sf0.001")
#: The library's own queries; those of the optional subpackage have their own tests.
from silverline.plans import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(got.columns) > 0  # rows-only query: it runs over the whole table
        return
    want = duck.execute(ORACLE[name]).df()
    a, b = digest(got), digest(want)
    assert a[0] == b[0], f"row count {a[0]} != {b[0]}"
    assert a[1] == b[1], f"columns {a[1]} != {b[1]}"
    assert a[2] == b[2], f"values differ: {sorted(set(a[3]) ^ set(b[3]))[:4]}"
