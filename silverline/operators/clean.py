"""Frame-wide cleaning and schema helpers (STR-1..4 over frames, PRJ-2..14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType, TimestampType

from silverline.functions import strings as S


def string_columns(df: DataFrame) -> list[str]:
    """PRJ-7: names of top-level string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """STR-3 on every (or the given) string column in ONE projection:
    collapse whitespace, strip, blank -> NULL."""
    targets = set(columns if columns is not None else string_columns(df))
    return df.select([S.clean_text(F.col(c)).alias(c) if c in targets else F.col(c)
                      for c in df.columns])


def nullify_sentinels(df: DataFrame, sentinels: list[str], columns: list[str] | None = None) -> DataFrame:
    """STR-4 on every (or the given) string column."""
    targets = set(columns if columns is not None else string_columns(df))
    return df.select([S.sentinel_to_null(F.col(c), sentinels).alias(c) if c in targets else F.col(c)
                      for c in df.columns])


def rename_all(df: DataFrame, fn=S.snake_case_name) -> DataFrame:
    """PRJ-6: rename every column by a function; two names that map to one
    are an error rather than a silent overwrite."""
    new = [fn(c) for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"column names collide after renaming: {dup}")
    return df.toDF(*new)


def rename_with_suffix(df: DataFrame, columns: list[str], suffix: str) -> DataFrame:
    """PRJ-5: suffix a subset of columns."""
    return df.withColumnsRenamed({c: c + suffix for c in columns if c in df.columns})


def drop_strict(df: DataFrame, *columns: str) -> DataFrame:
    """PRJ-3 that fails on a missing name (Spark's ``drop`` ignores it)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"cannot drop missing columns {missing}")
    return df.drop(*columns)


def datetimes_to_dates(df: DataFrame) -> DataFrame:
    """PRJ-8: every timestamp column -> DATE."""
    return df.select([F.to_date(F.col(f.name)).alias(f.name)
                      if isinstance(f.dataType, (TimestampType, TimestampNTZType)) else F.col(f.name)
                      for f in df.schema.fields])


def add_missing_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """PRJ-9 / PRJ-10: add each contract column the frame lacks as a typed NULL."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """PRJ-13 / PRJ-14: project to ``schema`` in its order and types.  Missing
    columns become typed NULLs.  ``strict=False`` uses ``try_cast`` so a bad
    cell becomes NULL (and a contract rule can report it) instead of aborting
    the job."""
    df = add_missing_columns(df, schema)
    return df.select([(F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType))
                      .alias(f.name) for f in schema.fields])


def cast_like(df: DataFrame, other: DataFrame) -> DataFrame:
    """PRJ-14: cast the shared columns of ``df`` to ``other``'s types."""
    types = {f.name: f.dataType for f in other.schema.fields}
    return df.select([F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
