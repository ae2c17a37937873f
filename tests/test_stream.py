"""STM-1..3: new keys across micro-batches and restarts; streamed upsert
equals the batch upsert."""

import os

from pyspark.sql import functions as F

from silverline.operators import upsert
from silverline.streaming import jobs


def _write(spark, path, rows):
    spark.createDataFrame(rows, "user_id long, ts timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(path)


def test_new_keys_two_batches_and_restart(spark, tmp_path):
    import datetime as dt
    src = str(tmp_path / "src")
    t = dt.datetime(2024, 1, 1)
    _write(spark, os.path.join(src, "b0"), [(1, t), (2, t)])
    _write(spark, os.path.join(src, "b1"), [(2, t), (3, t)])
    schema = spark.read.parquet(os.path.join(src, "b0")).schema
    out = str(tmp_path / "out")
    stream = lambda: jobs.file_stream(spark, src + "/*", schema, max_files=1)
    jobs.new_key_stream(stream(), "user_id", "ts", out)
    log = jobs.read_key_log(spark, out)
    assert sorted((r.user_id, r.batch_id) for r in log.collect()) == [(1, 0), (2, 0), (3, 1)]
    # restart on the same checkpoint: old files are not replayed, a new file is
    _write(spark, os.path.join(src, "b2"), [(3, t), (4, t)])
    jobs.new_key_stream(stream(), "user_id", "ts", out)
    log = jobs.read_key_log(spark, out)
    assert sorted((r.user_id, r.batch_id) for r in log.collect()) == [(1, 0), (2, 0), (3, 1), (4, 2)]


def test_new_keys_read_the_state_and_not_the_log(spark, tmp_path):
    """Each batch touches the state of its own keys; the log may be gone; a retried batch writes the same rows."""
    import datetime as dt
    import json
    import shutil
    t = dt.datetime(2024, 1, 1)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for k in range(3):  # 200 keys, 2 of them again, then 1 new and 1 again
        _write(spark, os.path.join(src, f"b{k}"), [[(i, t) for i in range(200)], [(5, t), (6, t)], [(7, t), (900, t - dt.timedelta(days=k)), (900, t)]][k])
        q = jobs.new_key_stream(jobs.file_stream(spark, src + "/*", spark.read.parquet(os.path.join(src, "b0")).schema), "user_id", "ts", out)
        state = q.lastProgress["stateOperators"][0]
        assert (state["numRowsUpdated"], state["numRowsTotal"]) == [(200, 200), (2, 200), (2, 201)][k]
        assert "rocksdb" in json.dumps(state["customMetrics"]).lower()
        got = [(r.user_id, r.first_seen) for r in spark.read.parquet(f"{out}/log/batch_id={k}").collect()]
        assert len(got) == [200, 0, 1][k] and (k < 2 or got == [(900, t - dt.timedelta(days=2))])
        if k == 0:
            shutil.move(f"{out}/log", f"{out}/log-elsewhere")
    # the last batch is taken as not committed and runs again
    commits = f"{out}/checkpoint/commits"
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{commits}/{name}"):
            shutil.move(f"{commits}/{name}", str(tmp_path / f"commit{name}"))
    jobs.new_key_stream(jobs.file_stream(spark, src + "/*", spark.read.parquet(os.path.join(src, "b0")).schema), "user_id", "ts", out)
    assert [r.user_id for r in spark.read.parquet(f"{out}/log/batch_id=2").collect()] == [900]


def test_stream_upsert_equals_batch(spark, tmp_path):
    cur = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "k long, v string")
    new = spark.createDataFrame([(i, f"v{i}" if i % 2 else f"w{i}") for i in range(5, 15)], "k long, v string")
    inc = str(tmp_path / "inc")
    new.repartition(3, F.col("k") % 3).write.parquet(inc)
    src = jobs.file_stream(spark, inc, new.schema, max_files=1)
    rows = lambda df: sorted(tuple(r) for r in df.select("k", "v", "created_at", "updated_at").collect())
    out = str(tmp_path / "w")
    last = rows(jobs.upsert_stream(src, cur, ["k"], "2024-06-01", out, buckets=4))
    # restart on the same folder with nothing new: the same rows, whatever is passed as the first state
    again = jobs.upsert_stream(jobs.file_stream(spark, inc, new.schema, max_files=1), cur.limit(0), ["k"], "2024-06-01", out, buckets=4)
    assert rows(again) == last == rows(upsert.upsert(cur, new, ["k"], "2024-06-01"))
    assert len({r[0] for r in last}) == len(last) == 15


def test_stream_upsert_rewrites_touched_buckets_and_keeps_one_row_per_key(spark, tmp_path):
    cur = spark.createDataFrame([(i, "a", 0) for i in range(100)], "k long, v string, sent int")
    inc, out = str(tmp_path / "inc"), str(tmp_path / "w")
    spark.createDataFrame([(3, "old", 1), (3, "new", 2), (200, "x", 1), (200, "y", 2)], cur.schema).coalesce(1).write.parquet(inc)
    last = jobs.upsert_stream(jobs.file_stream(spark, inc, cur.schema), cur, ["k"], "2024-06-01", out, order=["sent"], buckets=8)
    got = {r.k: r.v for r in last.collect()}
    assert last.count() == len(got) == 101 and got[3] == "new" and got[200] == "y" and got[4] == "a"
    manifest = jobs._manifest(spark, out, 1)
    assert sorted(manifest) == list(range(8)) and 1 <= sum(v == 1 for v in manifest.values()) <= 2


def test_a_broken_log_is_an_error_not_an_empty_log(spark, tmp_path):
    import datetime as dt

    import pytest
    log = tmp_path / "log" / "batch_id=0"
    log.mkdir(parents=True)
    (log / "part-0.parquet").write_text("not parquet")
    batch = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "user_id long, ts timestamp_ntz")
    with pytest.raises(Exception, match="(?i)parquet"):
        jobs.emit_new_keys(batch, 1, "user_id", "ts", str(tmp_path / "log"))


def test_replayed_batch_is_idempotent(spark, tmp_path):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    log = str(tmp_path / "log")
    b0 = spark.createDataFrame([(1, t), (2, t)], "user_id long, ts timestamp_ntz")
    b1 = spark.createDataFrame([(2, t), (3, t), (3, t)], "user_id long, ts timestamp_ntz")
    jobs.emit_new_keys(b0, 0, "user_id", "ts", log)
    first = sorted(r.user_id for r in jobs.emit_new_keys(b1, 1, "user_id", "ts", log).collect())
    again = sorted(r.user_id for r in jobs.emit_new_keys(b1, 1, "user_id", "ts", log).collect())  # replay
    assert first == again == [3]
    everything = spark.read.parquet(log)
    assert sorted((r.user_id, r.batch_id) for r in everything.collect()) == [(1, 0), (2, 0), (3, 1)]
