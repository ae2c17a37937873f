"""Readers and writers (SRC-1..11, SNK-1..4).

All readers take an explicit schema where one is known: inference is an extra
full pass over the input and is only offered as an opt-in (SRC-7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """SRC-1 / SRC-2: parquet table or snapshot."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_json_records(spark: SparkSession, path: str, schema: StructType | None = None,
                      record_path: str | None = None, multiline: bool = True,
                      full_scan_inference: bool = False) -> DataFrame:
    """SRC-4 / SRC-5 / SRC-6 / SRC-7: JSON documents -> one row per record.

    ``record_path`` navigates a nested document to its record array
    (``"result.pageContext.coins"``); the array is exploded and its struct
    fields become columns.  With ``schema`` given no inference pass runs;
    ``full_scan_inference`` samples every document (``samplingRatio=1``).
    """
    reader = spark.read.option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif full_scan_inference:
        reader = reader.option("samplingRatio", "1.0")
    df = reader.json(path)
    if record_path:
        df = df.select(F.explode_outer(F.col(record_path)).alias("_rec")).select("_rec.*")
    return df


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """SRC-8: CSV with a header row."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_pages(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """SRC-9: a folder of stored pages -> ``(page_key, url, html)``.

    Each file is one row (``wholetext``); the key is the file stem taken from
    the hidden ``_metadata`` column, so no driver-side listing is needed.
    """
    df = (spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True)
          .select(F.col("_metadata.file_name").alias("file_name"),
                  F.col("_metadata.file_path").alias("url"),
                  F.col("value").alias("html")))
    return df.select(F.regexp_extract("file_name", r"^(.*?)(\.[^.]*)?$", 1).alias("page_key"),
                     "url", "html")


def ragged_to_columns(kv: Column, columns: list[str], prefix: str = "") -> list[Column]:
    """SRC-10 / SRC-11: a ``map<string,string>`` of ragged keys -> one column
    per wanted key; a key missing from a row becomes NULL.  The map itself can
    be kept next to the columns so unknown keys are not lost."""
    return [kv[c].alias(prefix + c) for c in columns]


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """SNK-1 / SNK-3 / SNK-4.  Never write to a path that the plan reads."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_tables(df: DataFrame, folder: str, stem: str) -> None:
    """SNK-2: CSV + parquet twins of one frame.

    Nested columns cannot go to CSV, so arrays/maps/structs are rendered with
    ``to_json`` for the CSV copy only.  The frame is persisted once so both
    writers reuse one evaluation.
    """
    from pyspark.sql.types import ArrayType, MapType, StructType as ST

    cached = df.persist()
    try:
        write_parquet(cached, f"{folder.rstrip('/')}/{stem}.parquet")
        flat = cached.select([
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (ArrayType, MapType, ST)) else F.col(f.name)
            for f in cached.schema.fields
        ])
        flat.write.mode("overwrite").option("header", "true").csv(f"{folder.rstrip('/')}/{stem}.csv")
    finally:
        cached.unpersist()


def require_min_rows(df: DataFrame, n: int, what: str = "input") -> DataFrame:
    """FLT-12: raise when ``df`` has fewer than ``n`` rows.  Reads at most
    ``n`` rows (``limit`` then ``count``), so the guard is bounded."""
    have = df.limit(n).count()
    if have < n:
        raise ValueError(f"{what}: expected at least {n} rows, found {have}")
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """SRC-2 when the table lives in a SQL database: a parallel JDBC read
    split on ``partition_column``.  (Needs the database's JDBC driver on the
    classpath; none is bundled.)"""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, mode: str = "append",
               properties: dict | None = None) -> None:
    """SRT-7 / SNK-5: write rows in batches of ``batch_size`` per statement,
    each task writing its own partition."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
