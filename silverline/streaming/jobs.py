"""Streaming re-aims of the poll loop (STM-1..3).

* ``new_key_stream``: emit every key the first time it appears.  Each
  micro-batch takes its distinct keys, ``left_anti`` joins them with the key
  log of EARLIER batches, and writes the survivors to ``log/batch_id=N``.
  A retried batch overwrites its own partition and never sees its own
  output, so delivery is idempotent per ``batch_id``.
* ``upsert_stream``: every micro-batch turns snapshot version N into version
  N+1 with ``upsert``, rewriting only the key buckets it touches; versions are
  written tables, so lineage is cut at every batch and a retry recomputes the
  same version from the same input.

Poll interval (STM-2): ``trigger(processingTime="1 hour")`` in production;
tests and queries use ``availableNow`` so the stream drains and stops.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.operators import upsert as U
from silverline.session import checkpoint_dir, path_exists, stored


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    path = os.path.join(base, "silverline", f"{name}-{uuid.uuid4().hex}")
    return path


def file_stream(spark: SparkSession, path: str, schema, max_files: int = 1, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def emit_new_keys(batch: DataFrame, batch_id: int, key: str, ts: str, log_path: str) -> DataFrame:
    """STM-1 without a stream, one delivery: distinct keys of ``batch`` (with their first
    time) that no EARLIER batch logged, written to ``log/batch_id=N``.

    Re-running the same ``batch_id`` (a retry after a failure between the
    write and the checkpoint commit) overwrites that partition with the same
    rows and never sees its own output, so emission is exactly-once per
    batch.  Only a log that is not there counts as empty; any other failure
    to read it is raised.  Returns the emitted rows (read back from the log)."""
    spark = batch.sparkSession
    fresh = batch.groupBy(key).agg(F.min(ts).alias("first_seen"))
    if path_exists(spark, log_path):
        known = spark.read.schema(T.StructType([*fresh.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(log_path)
        fresh = fresh.join(known.filter(F.col("batch_id") < batch_id).select(key), key, "left_anti")
    out = os.path.join(log_path, f"batch_id={batch_id}")
    fresh.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def first_seen(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """STM-1 as a streaming aggregate (update mode): the keys of each
    micro-batch with their first time, and whether an earlier batch had them
    (``known``).  The time of a batch is the same in all its rows and in a
    retry, so a key is new in the batch in which it was born."""
    return (stream.withColumn("_batch", F.current_timestamp()).groupBy(key)
            .agg(F.min(ts).alias("first_seen"), F.min("_batch").alias("_born"), F.max("_batch").alias("_touched"))
            .select(key, "first_seen", (F.col("_born") < F.col("_touched")).alias("known")))


def new_key_stream(stream: DataFrame, key: str, ts: str, out_dir: str, trigger: dict | None = None,
                   await_end: bool = True):
    """STM-1: start the stream; returns the ``StreamingQuery``.

    What has been seen is the state of a streaming aggregate in RocksDB, on
    the executors' disks and as changes in the checkpoint, so a batch reads
    and writes the state of its own keys and never the log.  New keys go to
    ``log/batch_id=N``; a retried batch starts from the same state and writes
    the same rows over its own."""
    spark = stream.sparkSession
    log_path = os.path.join(out_dir, "log")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.filter(~F.col("known")).drop("known").write.mode("overwrite").parquet(os.path.join(log_path, f"batch_id={batch_id}"))

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:  # the query keeps the provider that it started with
        q = (first_seen(stream, key, ts).writeStream.outputMode("update").foreachBatch(on_batch)
             .option("checkpointLocation", os.path.join(out_dir, "checkpoint"))
             .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    if await_end:
        q.awaitTermination()
    return q


def read_key_log(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "log"))


BUCKET = "snapshot_bucket"


def _bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def _manifest(spark: SparkSession, out_dir: str, version: int) -> dict[int, int]:
    """Bucket -> version that wrote it last; at most one row per bucket."""
    path = os.path.join(out_dir, "manifest", f"v={version}")
    return {r["bucket"]: r["version"] for r in spark.read.parquet(path).select("bucket", "version").collect()}


def _write_version(df: DataFrame, out_dir: str, version: int, before: dict[int, int], touched: list[int]) -> None:
    """Write the touched buckets of a version, and its manifest last: a
    version without a manifest does not exist."""
    spark = df.sparkSession
    # whole files per bucket; a bucket may take several tasks under AQE
    (df.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET)
     .parquet(os.path.join(out_dir, "snapshot", f"v={version}")))
    rows = [(b, v) for b, v in (before | dict.fromkeys(touched, version)).items()]
    (spark.createDataFrame(rows, "bucket int, version int").coalesce(1)
     .write.mode("overwrite").parquet(os.path.join(out_dir, "manifest", f"v={version}")))


def read_snapshot(spark: SparkSession, out_dir: str, version: int, schema, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version: each bucket from the version that wrote it last."""
    manifest = _manifest(spark, out_dir, version)
    paths = [os.path.join(out_dir, "snapshot", f"v={v}", f"{BUCKET}={b}") for b, v in sorted(manifest.items())
             if buckets is None or b in buckets]
    paths = [p for p in paths if path_exists(spark, p)]  # a bucket whose rows are all gone has no folder
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_stream(stream: DataFrame, initial: DataFrame, key: list[str], as_of, out_dir: str,
                  trigger: dict | None = None, exclude_float: bool = True, order: list[str] | None = None,
                  buckets: int = 64) -> DataFrame:
    """STM-3: fold micro-batches into versioned snapshots; returns the rows of
    the latest version.

    A snapshot is dealt into ``buckets`` by a hash of the key.  Batch N reads
    only the buckets its keys fall into, from version N, and writes them as
    version N+1; a manifest per version names the version of every bucket.  So
    a batch costs its own buckets, not the table.  A retried batch rewrites
    the same version from the same input, and a restarted stream resumes from
    its checkpoint.  Only a manifest that is not there means "first run"."""
    spark = stream.sparkSession
    if not path_exists(spark, os.path.join(out_dir, "manifest", "v=0", "_SUCCESS")):
        _write_version(_bucketed(initial, key, buckets), out_dir, 0, {}, list(range(buckets)))
    schema = T.StructType([f for f in U.upsert(initial.limit(0), spark.createDataFrame([], stream.schema), key, as_of).schema.fields])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = stored(_bucketed(batch, key, buckets), "stream-batch")
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # at most one row per bucket
        before = _manifest(spark, out_dir, batch_id)
        cur = read_snapshot(spark, out_dir, batch_id, schema, touched)
        nxt = U.upsert(cur, batch.drop(BUCKET), key, as_of, exclude_float, order=order)
        _write_version(_bucketed(nxt, key, buckets), out_dir, batch_id + 1, before, touched)
        spark.createDataFrame([(batch_id + 1,)], "version int").write.mode("overwrite").parquet(os.path.join(out_dir, "latest"))

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", os.path.join(out_dir, "checkpoint"))
         .trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination()
    marker = os.path.join(out_dir, "latest")
    latest = spark.read.parquet(marker).first()["version"] if path_exists(spark, marker) else 0  # one row
    return read_snapshot(spark, out_dir, latest, schema)
