"""Dense numbers and batches of exactly n rows, taken up again after a kill."""

import glob
import os

from pyspark.sql import functions as F

from silverline.operators import numbering as N


def test_numbers_are_dense_in_order(spark):
    rows = [(i * 7919 % 100, f"v{i % 3}") for i in range(500)] + [(5, "same")] * 40 + [(None, None)]
    df = spark.createDataFrame(rows, "k long, v string").repartition(6)
    got = [(r.k, r.v, r.row_no) for r in N.numbered(df, ["k"]).orderBy("row_no").collect()]
    want = sorted(rows, key=lambda r: (r[0] is not None, r))
    assert [g[2] for g in got] == list(range(len(rows))) and [g[:2] for g in got] == want
    down = N.numbered(df, [F.desc("k")]).orderBy("row_no").first()
    assert down.k == 99
    assert N.numbered(df.limit(0), ["k"]).count() == 0


def test_batches_have_exactly_n_rows_and_a_killed_run_goes_on(spark, tmp_path):
    df = spark.range(1050).withColumn("v", F.col("id") % 10)
    path = f"{tmp_path}/out"
    # a run that wrote three batches, and half of a fourth, before it was killed
    done = N.batches(df, 100, ["id"]).filter("batch < 3 or batch = 3 and place < 50")
    done.repartition("batch").write.partitionBy("batch").parquet(path)
    stamp = {p: os.stat(p).st_mtime_ns for b in range(3) for p in glob.glob(f"{path}/batch={b}/*.parquet")}
    assert N.write_batches(df, 100, ["id"], path) == list(range(3, 11))
    out = spark.read.parquet(path)
    assert {r.batch: r["count"] for r in out.groupBy("batch").count().collect()} == {b: 100 if b < 10 else 50 for b in range(11)}
    assert {p: os.stat(p).st_mtime_ns for p in stamp} == stamp
    assert [r.id for r in N.read_batch(out, 3).collect()] == list(range(300, 400)) and out.select("id").distinct().count() == 1050
    assert N.write_batches(df, 100, ["id"], path) == []
    assert N.write_batches(df.limit(0), 100, ["id"], f"{tmp_path}/none") == []
