"""UPS-1 / UPS-3 by bucket digests: a keyed table whose unchanged parts are
neither read nor written.

Rows are dealt into buckets by a function of the key.  Beside each version of
the table stands, for every bucket, the version that wrote it and a digest of
the rows that came in for it: their number, the sum of one 64-bit hash of the
row and the exclusive or of another, all of which combine map-side and do not
depend on the order of rows.  A bucket whose incoming rows have the digest of
the last time would change nothing, so an update reads the incoming rows once
for their digests and after that only the rows, old and new, of the buckets
that differ.  The hashes cover the columns that count as a change (no floats,
no audit columns), with nulls told apart from their place.

Layout under ``root``: ``data/v=<n>/bucket=<b>`` and ``manifest/v=<n>``, which
is written last: a version without a whole manifest does not exist, and a rerun
writes over it.  The driver sees one row per bucket.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.operators import upsert
from silverline.operators.release import _files
from silverline.session import path_exists

BUCKET = "bucket"
_MANIFEST = "bucket int, version int, n long, total decimal(38,0), mixed long, schema string"


def by_key(key: list[str], buckets: int = 64) -> Column:
    """The usual bucket: a hash of the key."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")


def row_hash(columns: list[str], seed: int) -> Column:
    """64-bit hash of some columns; a null is no empty column."""
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def digests(rows: DataFrame, bucket: Column, exclude_float: bool = True) -> DataFrame:
    """(bucket, n, total, mixed): the digest of each bucket's rows."""
    columns = upsert.comparison_columns(rows, rows, exclude_float)
    return (rows.groupBy(bucket.alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_hash(columns, 1).cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor(row_hash(columns, 2)).alias("mixed")))


@dataclass(frozen=True)
class State:
    """A version: for each bucket (version that wrote it, digest of what came
    in), and the schema of its rows as JSON."""

    number: int
    buckets: dict[int, tuple]
    schema: str = ""


def state(spark: SparkSession, root: str, number: int | None = None) -> State:
    """A version of the table, the newest by default; number 0 without buckets if there is none."""
    if number is None:
        fs, path = _files(spark, root)
        folder = path(f"{root}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        number = max((int(n[2:]) for n in names if n.startswith("v=") and path_exists(spark, f"{root}/manifest/{n}/_SUCCESS")), default=0)
    if not number:
        return State(0, {})
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/v={number}").collect()  # one row per bucket
    if not rows:  # nothing ever came in
        return State(0, {})
    return State(number, {r.bucket: (r.version, (r.n, r.total, r.mixed)) for r in rows}, rows[0].schema)


def read(spark: SparkSession, root: str, number: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version, of some buckets only if named."""
    found = state(spark, root, number)
    if not found.number:
        raise FileNotFoundError(f"no version of {root}")
    schema = T.StructType.fromJson(json.loads(found.schema))
    paths = [f"{root}/data/v={v}/{BUCKET}={b}" for b, (v, _) in sorted(found.buckets.items()) if buckets is None or b in buckets]
    paths = [p for p in paths if path_exists(spark, p)]  # a bucket whose rows are all gone has no folder
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _differing(before: State, new: DataFrame, bucket: Column, exclude_float: bool, prune_missing: bool) -> dict[int, tuple]:
    """The buckets whose incoming rows are not those of the last time, and their digests."""
    now = {r[BUCKET]: (r.n, r.total, r.mixed) for r in digests(new, bucket, exclude_float).collect()}  # one row per bucket
    out = {b: d for b, d in now.items() if b not in before.buckets or before.buckets[b][1] != d}
    if prune_missing:
        out |= {b: (0, None, None) for b, (_, d) in before.buckets.items() if b not in now and d[0]}
    return out


def changed_rows(spark: SparkSession, root: str, new: DataFrame, bucket: Column, exclude_float: bool = True) -> DataFrame:
    """UPS-1: the rows of ``new``, one per key, that the newest version lacks,
    as ``upsert.changed_rows`` finds them; buckets with equal digests are not read."""
    before = state(spark, root)
    touched = sorted(_differing(before, new, bucket, exclude_float, False))
    if not before.number:
        return new
    return upsert.changed_rows(new.filter(bucket.isin(touched)), read(spark, root, before.number, touched), exclude_float)


def publish(spark: SparkSession, root: str, new: DataFrame, key: list[str], as_of, bucket: Column | None = None, buckets: int = 64,
            prune_missing: bool = False, exclude_float: bool = True, order: list[str] | None = None) -> State:
    """UPS-3: the next version, with the rows that ``upsert`` gives; only
    buckets whose incoming rows differ from the last time are read and
    written.  Without such a bucket there is no new version.  ``bucket`` must
    be a function of the key, the same one on every call."""
    bucket = by_key(key, buckets) if bucket is None else bucket
    before = state(spark, root)
    touched = _differing(before, new, bucket, exclude_float, prune_missing)
    if not touched and before.number:
        return before
    if before.number:
        current = read(spark, root, before.number, sorted(touched))
    else:
        current = new.limit(0).withColumns({c: F.lit(None).cast("timestamp_ntz") for c in upsert.AUDIT_COLUMNS})
    rows = upsert.upsert(current, new.filter(bucket.isin(sorted(touched))), key, as_of, exclude_float, prune_missing=prune_missing, order=order)
    number = before.number + 1
    schema = rows.schema.json()
    rows = rows.withColumn(BUCKET, bucket)
    # whole files per bucket; a bucket may take several tasks under AQE
    rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/data/v={number}")
    after = State(number, before.buckets | {b: (number, d) for b, d in touched.items()}, schema)
    listed = [(b, v, *d, schema) for b, (v, d) in sorted(after.buckets.items())]
    spark.createDataFrame(listed, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v={number}")
    return after
