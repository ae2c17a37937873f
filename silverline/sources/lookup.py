"""SRC-1 with FLT-2 / FLT-4: point lookups in a large table.

Written once, the table is sorted by one column, so that the least and
greatest value of a row group tell where a value can be, and holds Parquet
Bloom filters for columns that it is not sorted by.  A lookup is a filter that
Spark pushes into the scan: row groups that cannot hold a value are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Values that a lookup states in its filter; more are joined.
MAX_VALUES = 1000


def write_lookup(df: DataFrame, path: str, sort_by: list[str], bloom: list[str] = (), row_group_bytes: int = 128 << 20,
                 bloom_bytes: int = 1 << 20) -> None:
    """SNK-1: write ``df`` in ranges of ``sort_by``, sorted inside, with Bloom
    filters on the columns ``bloom``: as large as a row group's values need, at
    most ``bloom_bytes`` (a full filter lets row groups through and loses none)."""
    writer = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", bloom_bytes).parquet(path)


def is_one_of(spark: SparkSession, column: str, values: list) -> Column:
    """Membership that reaches the row groups: Spark pushes a list longer than
    its threshold as one range from least to greatest, so the sorted values go
    in lists of that length.  A null is in no list."""
    step = max(1, int(spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold", "10")))
    known = sorted({v for v in values if v is not None})
    lists = [F.col(f"`{column}`").isin(known[i:i + step]) for i in range(0, len(known), step)]
    while len(lists) > 1:  # a balanced tree
        lists = [reduce(Column.__or__, lists[i:i + 2]) for i in range(0, len(lists), 2)]
    return lists[0] if lists else F.lit(False)


def lookup(table: DataFrame, column: str, values: list) -> DataFrame:
    """The rows of ``table`` whose ``column`` is one of some values."""
    return table.filter(is_one_of(table.sparkSession, column, values))


def lookup_keys(table: DataFrame, column: str, keys: DataFrame, key: str, max_values: int = MAX_VALUES) -> DataFrame:
    """The rows of ``table`` whose ``column`` is a ``key`` of another frame.
    Up to ``max_values`` different keys become a pushed filter; more are a
    semi join, in which a lookup of single row groups would gain nothing."""
    wanted = keys.select(F.col(f"`{key}`").alias("_key")).filter("_key is not null").distinct()
    found = wanted.limit(max_values + 1).collect()
    if len(found) <= max_values:
        return lookup(table, column, [r[0] for r in found])
    return table.join(wanted, F.col(f"`{column}`") == F.col("_key"), "left_semi")
