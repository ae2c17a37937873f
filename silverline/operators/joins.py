"""Join helpers: cardinality guards, lookups (JOIN-1, JOIN-5, JOIN-6, DQ-11).

No join here carries a broadcast hint: Spark broadcasts a side by file
statistics or, under AQE, by the size that its stage turned out to have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count.  A partial+final
    aggregate, so a hot key is combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique(df: DataFrame, keys: list[str], what: str = "frame") -> None:
    """DQ-11 / JOIN-1 ``validate='1:1'``: raise when ``keys`` is not a key."""
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"{what}: {keys} is not unique, e.g. {[r.asDict() for r in bad]}")


def left_join_checked(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """JOIN-1: left join after checking that ``on`` is a key of both sides."""
    assert_unique(left, on, "left side")
    assert_unique(right, on, "right side")
    return left.join(right, on, "left")


def literal_map(mapping: dict) -> Column:
    """A literal ``map`` column.  Keys must be distinct (Spark rejects a
    duplicate literal key), so callers dedup first."""
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])


def lookup_with_default(c: Column, mapping: dict) -> Column:
    """JOIN-5: mapped value, or the input itself when unmapped."""
    return F.coalesce(literal_map(mapping)[c], c)


def lookup_strict(c: Column, mapping: dict, fail: bool = False) -> Column:
    """JOIN-6: mapped value; NULL stays NULL; an unmapped non-NULL value is
    NULL (reported by a contract rule) or, with ``fail``, raises."""
    mapped = literal_map(mapping)[c]
    if fail:
        return F.when(c.isNull() | mapped.isNotNull(), mapped).otherwise(
            F.raise_error(F.concat(F.lit("unmapped value: "), c)))
    return mapped


def lookup_table(df: DataFrame, col: str, table: DataFrame, key: str, value: str,
                 out: str, keep_unmapped: bool = True) -> DataFrame:
    """JOIN-5 / JOIN-6 against a user table ``(key, value)``: left join, then
    ``coalesce`` with the input for the keep-unmapped variant."""
    t = table.select(F.col(key).alias("_lk"), F.col(value).alias("_lv")).dropDuplicates(["_lk"])
    j = df.join(t, F.col(col) == F.col("_lk"), "left")
    res = F.coalesce(F.col("_lv"), F.col(col)) if keep_unmapped else F.col("_lv")
    return j.withColumn(out, res).drop("_lk", "_lv")
