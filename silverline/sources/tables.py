"""Catalogue of the driver-generated test tables (SRC-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table.  Column pruning and filter pushdown reach the
    parquet scan because the plan stays declarative.

    The schema is inferred once per path and then given explicitly, so
    later reads of the same (read-only) table start no schema-inference
    job."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def register_views(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> None:
    """Register test tables as temp views (SRC-2/3: ``spark.sql``); each
    registration reads only the parquet footer."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
