"""Bucket digests: equal to the plain upsert, unchanged buckets untouched."""

import glob

import pytest
from pyspark.sql import functions as F

from silverline.operators import digest, upsert

COLUMNS = "k long, v string, w string, x double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, values):
    return spark.createDataFrame(values, COLUMNS)


@pytest.mark.parametrize("prune", [False, True])
def test_equal_to_the_plain_upsert(spark, tmp_path, prune):
    runs = [[(i, f"v{i}", None, 1.0) for i in range(100)],
            [(i, f"v{i}", None if i != 7 else "", 2.0) for i in range(90) if i != 40] + [(500, "new", "n", 0.0)],
            [(i, None, f"v{i}", 2.0) for i in range(3)]]
    root, plain = str(tmp_path), None
    for day, values in enumerate(runs):
        new = frame(spark, values)
        current = plain if plain is not None else new.limit(0).withColumns({c: F.lit(None).cast("timestamp_ntz") for c in upsert.AUDIT_COLUMNS})
        if plain is not None:
            assert rows(digest.changed_rows(spark, root, new, digest.by_key(["k"], 8))) == rows(upsert.changed_rows(new, plain))
        plain = upsert.upsert(current, new, ["k"], f"2024-06-0{day + 1}", prune_missing=prune)
        after = digest.publish(spark, root, new, ["k"], f"2024-06-0{day + 1}", buckets=8, prune_missing=prune)
        assert after.number == day + 1 and rows(digest.read(spark, root)) == rows(plain)
    # float noise alone makes no version; the first one can still be read
    assert digest.publish(spark, root, new.withColumn("x", F.col("x") + 9), ["k"], "2024-07-01", buckets=8, prune_missing=prune).number == 3
    assert digest.read(spark, root, 1).count() == 100


def test_unchanged_buckets_are_neither_read_nor_written(spark, tmp_path):
    root, by = str(tmp_path), F.pmod("k", F.lit(4)).cast("int")
    values = [(i, f"v{i}", None, 1.0) for i in range(40)]
    digest.publish(spark, root, frame(spark, values), ["k"], "2024-06-01", bucket=by)
    for b in (0, 1, 3):  # files that could not be read
        for path in glob.glob(f"{root}/data/v=1/bucket={b}/*.parquet"):
            with open(path, "wb") as f:
                f.write(b"not parquet")
    values[2] = (2, "other", None, 1.0)
    after = digest.publish(spark, root, frame(spark, values), ["k"], "2024-06-02", bucket=by)
    assert {b: v for b, (v, _) in after.buckets.items()} == {0: 1, 1: 1, 2: 2, 3: 1}
    assert [p.rsplit("=", 1)[1] for p in glob.glob(f"{root}/data/v=2/bucket=*")] == ["2"]
    assert {r.k: r.v for r in digest.read(spark, root, buckets=[2]).collect()}[2] == "other"
    assert digest.changed_rows(spark, root, frame(spark, values), by).count() == 0


def test_digests_tell_what_matters(spark):
    one = lambda *values: [tuple(r)[1:] for r in digest.digests(frame(spark, values), F.lit(0)).collect()]
    a, b = (1, "a", None, 0.0), (2, "b", "c", 0.0)
    assert one(a, b) == one(b, a) and one(a) != one(a, a) and one(a) != one((1, None, "a", 0.0))
    assert one((1, "", None, 0.0)) != one((1, None, "", 0.0)) and one(a) == one((1, "a", None, 7.0)) and one((1, "a", "", 0.0)) != one(a)


def test_a_dead_run_is_written_over_and_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        digest.read(spark, root)
    digest.publish(spark, root, frame(spark, [(1, "a", None, 0.0)]), ["k"], "2024-06-01")
    # data of a version without a manifest
    frame(spark, [(9, "dead", None, 0.0)]).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{root}/data/v=2")
    assert digest.state(spark, root).number == 1 and [r.k for r in digest.read(spark, root).collect()] == [1]
    digest.publish(spark, root, frame(spark, [(1, "b", None, 0.0)]), ["k"], "2024-06-02")
    assert [(r.k, r.v) for r in digest.read(spark, root).collect()] == [(1, "b")]
    assert digest.publish(spark, root, frame(spark, []), ["k"], "2024-06-03", prune_missing=True).number == 3
    assert digest.read(spark, root).count() == 0
