"""EXT-8 over a stored set: the plain difference, without an exchange of the set."""

import pytest
from pyspark.sql import functions as F

from silverline.operators import extract as X
from silverline.operators import seen


def urls(df):
    return sorted((r.url for r in df.collect()), key=str)


def frame(spark, values, name="url"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("words", [64, 1])
def test_rounds_equal_the_plain_difference(spark, tmp_path, words):
    """Also with a filter that is full."""
    root = str(tmp_path / "s")
    found = frame(spark, [f"/p/{i}" for i in range(0, 3000, 2)] * 2 + [None, "", "ü"], "href")
    assert urls(seen.frontier_round(spark, root, found)) == urls(X.frontier_round(found, frame(spark, [])))
    held = []
    for step in (range(0, 1500), range(1000, 2500), []):
        held += [f"/p/{i}" for i in step] + [None, ""]
        seen.add(spark, root, frame(spark, held[-len(step) - 2:]), buckets=4, parts=2, words=words)
        assert urls(seen.frontier_round(spark, root, found)) == urls(X.frontier_round(found, frame(spark, held)))
    assert seen.versions(spark, root) == [1, 2, 3] and set(urls(seen.read(spark, root))) == set(held) - {None}
    sure, maybe = seen.possible_repeats(spark, root, found.select(F.col("href").alias("url")).distinct())
    assert sure.count() + maybe.count() == 1503 and (sure.count() > 100) == (words == 64)
    # a session that does not know the tables
    for n in seen.versions(spark, root):
        spark.sql(f"drop table {seen._name(root, n)}")
    assert urls(seen.frontier_round(spark, root, found)) == urls(X.frontier_round(found, frame(spark, held)))


def test_the_set_is_read_in_place(spark, tmp_path):
    root = str(tmp_path / "s")
    seen.add(spark, root, frame(spark, [f"/p/{i}" for i in range(2000)]), buckets=4, parts=2, words=256)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = seen.frontier_round(spark, root, frame(spark, ["/p/1", "/q"], "href"))._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = max(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above, depth = [], lines[at].index("- ")
    for line in reversed(lines[:at]):  # what stands above the scan in the tree
        if "- " in line and line.index("- ") < depth:
            depth = line.index("- ")
            above.append(line)
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert "LeftAnti" in above[join] and not any("Exchange" in line for line in above[:join]), above


def test_a_dead_run_is_written_over(spark, tmp_path):
    root = str(tmp_path / "s")
    seen.add(spark, root, frame(spark, ["/a"]), buckets=2, parts=1, words=8)
    frame(spark, ["/dead"]).write.parquet(f"{root}/data/v=2")  # no filter
    assert urls(seen.frontier_round(spark, root, frame(spark, ["/a", "/b", "/dead"], "href"))) == ["/b", "/dead"]
    assert seen.add(spark, root, frame(spark, ["/b"])) == 2
    assert urls(seen.frontier_round(spark, root, frame(spark, ["/a", "/b", "/dead"], "href"))) == ["/dead"] and urls(seen.read(spark, root)) == ["/a", "/b"]
