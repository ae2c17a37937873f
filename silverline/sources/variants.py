"""SRC-4..7, PRJ-11/12 without a declared schema: JSON documents as VARIANT.

Every document is parsed once, whatever its fields hold; a field that is a
number here and an object there stays what it is in each row.  ``field`` takes
one out as a type (NULL where it is not that), ``kind`` tells what it is, and
``field_types`` reports for every field how often it is what, so that conflicts
are seen before a schema is chosen.  Nothing is inferred beforehand: reading is
one pass over the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_variants(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(document variant, bad string) of a folder of JSON lines, or with
    ``whole`` of one document per file.  A text that is no JSON is kept in
    ``bad`` and its document is NULL; lines of white space are left out."""
    texts = spark.read.text(path, wholetext=whole).filter(F.btrim("value", F.lit(" \t\r\n")) != "")
    parsed = texts.withColumn("document", F.try_parse_json("value"))
    return parsed.select("document", F.when(F.col("document").isNull(), F.col("value")).alias("bad"))


def records(df: DataFrame, document: str, path: str, keep: list[str] | None = None) -> DataFrame:
    """SRC-5 / PRJ-12: one row for each element of the array at ``path`` (with
    its place); a document whose value there is no array, or is missing, gives
    one row with NULLs."""
    elements = F.try_variant_get(F.col(document), path, "array<variant>")
    return df.select(*(keep or []), F.posexplode_outer(elements).alias("place", "record"))


def field(document: Column | str, path: str, kind: str) -> Column:
    """PRJ-11: the value at ``path`` as a type; NULL where it is missing or something else."""
    return F.try_variant_get(document, path, kind)


def kind(document: Column | str, path: str = "$") -> Column:
    """What the value at ``path`` is: BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN,
    OBJECT, ARRAY, VOID (a JSON null); NULL where it is missing."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(document, path, "variant")), "^[A-Z]+", 0)


def field_types(df: DataFrame, document: str) -> DataFrame:
    """SRC-7: (field, kind, n_rows, conflict) over all rows: what each
    top-level field is how often; ``conflict`` where it is several things,
    nulls aside.  Documents that are no object have no fields."""
    return df.selectExpr(f"`{document}` as _document").lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("_document").outer())).filter("key is not null").select(
        F.col("key").alias("field"), kind("value").alias("kind")).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n_rows")).transform(_with_conflicts)


def _with_conflicts(types: DataFrame) -> DataFrame:
    several = (types.filter("kind <> 'VOID'").groupBy("field").agg(F.count(F.lit(1)).alias("kinds")).withColumnRenamed("field", "_field"))
    return types.join(several, F.col("field") == F.col("_field"), "left").select("field", "kind", "n_rows", F.coalesce(F.col("kinds") > 1, F.lit(False)).alias("conflict"))


def merged_schema(df: DataFrame, document: str) -> str:
    """The schema that all documents share, as ``schema_of_variant_agg`` tells it."""
    return df.agg(F.schema_of_variant_agg(F.col(document)).alias("schema")).first().schema
