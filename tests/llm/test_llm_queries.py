"""The registered queries: all there, and equal to their SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest
from silverline.llm.queries import ORACLE, QUERIES
from silverline.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in ORACLE:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        assert digest(got)[:3] == digest(con.execute(ORACLE[name]).df())[:3]
