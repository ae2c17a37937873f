"""SRT-7: dense numbers over all rows, and batches of exactly n rows.

Rows are dealt into sorted ranges, each range counts its own rows, and the
counts of the ranges before (one number per range) are added: no row passes
through one task.  Rows are put in the order of the given columns and then of
all others, so the same rows always get the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from silverline.session import path_exists, stored

BATCH, PLACE = "batch", "place"


def numbered(df: DataFrame, order: list[str | Column], name: str = "row_no") -> DataFrame:
    """``df`` with its place from 0 on, by ``order`` and then by all columns
    that can be sorted.  Only rows that are equal in all of these share a
    range, however many they are."""
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    by = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order] + ties
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                    .withColumn("_range", F.spark_partition_id()).withColumn("_inside", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "numbered")
    sizes = ranged.groupBy(F.col("_range").alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per range
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    return ranged.join(before, F.col("_range") == F.col("_part")).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_inside")).alias(name))


def batches(df: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    """``df`` with ``batch`` and ``place`` in it: every batch but the last has exactly ``n`` rows."""
    rows = numbered(df, order, "_row_no")
    return rows.withColumn(BATCH, F.floor(F.col("_row_no") / n).cast("long")).withColumn(PLACE, F.pmod("_row_no", F.lit(n)).cast("int")).drop("_row_no")


def write_batches(df: DataFrame, n: int, order: list[str | Column], path: str) -> list[int]:
    """Write batches of exactly ``n`` rows, each as a folder ``batch=<number>``
    under ``path``; the numbers written.  A run that was killed is taken up
    again: batches whose folder holds all their rows stay as they are, a
    partial one is written over."""
    spark = df.sparkSession
    rows = stored(batches(df, n, order), "batches")
    sizes = rows.groupBy(BATCH).agg(F.count(F.lit(1)).alias("_n"))
    todo = sizes
    if path_exists(spark, path) and spark.read.parquet(path).columns:
        held = spark.read.parquet(path).groupBy(F.col(BATCH).cast("long").alias(BATCH)).agg(F.count(F.lit(1)).alias("_n"))
        todo = sizes.join(held, [BATCH, "_n"], "left_anti")
    todo = stored(todo.select(BATCH), "batches-to-write")
    (rows.join(todo, BATCH, "left_semi").repartition(BATCH).sortWithinPartitions(BATCH, PLACE)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))
    return sorted(r[0] for r in todo.collect())  # one number per batch


def read_batch(df: DataFrame, number: int) -> DataFrame:
    """One batch of what was written, in its order; only its folder is read."""
    return df.filter(F.col(BATCH) == number).orderBy(PLACE)
