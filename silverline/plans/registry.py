"""Query registry: name -> (spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = "2024-12-31"  # fixed reference date of every query: no clock reads


TS_TEXT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_TEXT_SQL = "%Y-%m-%d %H:%M:%S.%f"


def register(name: str, sql: str | None = None, ts: tuple[str, ...] = ()):
    """Register a query.  Its DATE / TIMESTAMP columns leave the query as
    ISO text (``temporal_as_text``) so the result compares equal across
    engines whose client libraries map them to different Python types;
    ``ts`` names the timestamp columns of the oracle SQL, which gets the
    same formatting."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return temporal_as_text(fn(spark, sf_dir))

        run.__name__, run.__doc__, run.__wrapped__ = getattr(fn, "__name__", name), fn.__doc__, fn
        QUERIES[name] = run
        if sql is not None:
            if ts:
                repl = ", ".join(f"strftime({c}, '{TS_TEXT_SQL}') as {c}" for c in ts)
                ORACLE[name] = f"select * replace ({repl}) from ({sql}) _q"
            else:
                ORACLE[name] = sql
        return fn
    return deco


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def temporal_as_text(df):
    """DATE -> ``yyyy-MM-dd``, TIMESTAMP -> ``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

    def fmt(f):
        if isinstance(f.dataType, DateType):
            return F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(F.col(f.name), TS_TEXT_SPARK).alias(f.name)
        return F.col(f.name)

    if not any(isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)) for f in df.schema.fields):
        return df
    return df.select([fmt(f) for f in df.schema.fields])


def dates_as_text(df):
    """Render DATE columns as ISO ``yyyy-MM-dd`` text at the edge of a
    registered query, so the result compares equal across engines whose
    client libraries map DATE to different Python types.  Operators
    themselves keep DATE."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType

    return df.select([F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name)
                      if isinstance(f.dataType, DateType) else F.col(f.name) for f in df.schema.fields])
