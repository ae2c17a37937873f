"""Point lookups: the same rows as a plain filter, from few row groups."""

import pytest
from pyspark.sql import functions as F

from silverline.sources import lookup


def rows_read(df):
    """Rows that the scan of a collected frame has given, before the filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    rows = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("key"), F.md5(F.concat(F.col("id").cast("string"), F.lit("x"))).alias("other"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lookup.write_lookup(rows, path, ["id"], bloom=["key"], row_group_bytes=200_000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return spark.read.parquet(path)


def key(spark, *ids):
    return [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id long").select(F.md5(F.col("id").cast("string"))).collect()]


def test_sorted_column(spark, table):
    wanted = list(range(5, 200_000, 9_000))
    found = lookup.lookup(table, "id", [*wanted, None, 5, -1, 10**9])
    assert sorted(r.id for r in found.collect()) == wanted
    assert rows_read(lookup.lookup(table, "id", [77_777, 77_778])) <= 50_000
    assert rows_read(lookup.lookup(table, "id", [-5, 10**9])) == 0


def test_bloom_filters(spark, table):
    one = lookup.lookup(table, "key", key(spark, 123_456))
    assert [r.id for r in one.collect()] == [123_456] and rows_read(one) <= 50_000
    # least and greatest value of every row group enclose these, the Bloom filters do not hold them
    absent = lookup.lookup(table, "key", key(spark, 300_000, 300_001, 300_002))
    assert rows_read(absent) == 0
    # the same lookup on a column without a filter reads everything
    assert rows_read(lookup.lookup(table, "other", key(spark, 300_000, 300_001, 300_002))) >= 100_000


def test_no_values_nulls_and_many_keys(spark, table):
    assert lookup.lookup(table, "id", []).count() == lookup.lookup(table, "id", [None]).count() == 0
    keys = spark.range(0, 200_000, 1000).unionByName(spark.sql("select cast(null as long) as id")).select(F.col("id").alias("k"))
    for most in (3, 1000):
        assert lookup.lookup_keys(table, "id", keys, "k", max_values=most).count() == 200
    assert lookup.lookup_keys(table, "id", keys.limit(0), "k").count() == 0
