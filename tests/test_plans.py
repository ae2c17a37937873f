"""Plan-shape guards for the scale properties the library relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from silverline.plans import QUERIES
from silverline.operators import dedup, entity
from silverline.operators.contract import Contract

SF = "/root/testdata/sf0.001"
PYTHON_QUERIES = {"embedded_json", "embedded_first"}
#: Queries that show table functions written in Python.
TABLE_FUNCTIONS = {"objects_by_sql"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_row_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert ("ArrowEvalPythonUDTF" in p) == (name in TABLE_FUNCTIONS)
    p = p.replace("ArrowEvalPythonUDTF", "")
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert ("MapInPandas" in p or "MapInArrow" in p) == (name in PYTHON_QUERIES)


def hot_key_frame(spark, n=30000):
    # one key holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 97).alias("rate"), F.col("id").cast("string").alias("tag"))


def test_dedup_is_partial_aggregate_not_window(spark):
    df = dedup.keep_last(hot_key_frame(spark), ["k"], ["rate"])
    p = plan(df)
    assert "Window" not in p and "partial_max" in p
    hot = df.filter("k = 0").first()
    # ties on rate are broken by the remaining columns (tag compares as text)
    assert hot.rate == 96 and hot.tag == max(str(i) for i in range(0, 30000, 3) if i % 97 == 96)


def test_planning_starts_no_job(spark):
    """Sizes are left to Spark: building these frames runs nothing."""
    from pyspark.sql.types import LongType, StructField, StructType

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "frames only")
    names = spark.createDataFrame([("Bit-Coin",), ("bitcoin",)] * 50, "name string")
    named = entity.canonical_names(names, "name")
    checked = Contract(StructType([StructField("k", LongType(), False)]), primary_key=["k"]).check(hot_key_frame(spark).select("k"))
    assert not tracker.getJobIdsForGroup("lazy")
    assert {r.canonical_name for r in named.collect()} == {"Bit-Coin"}
    assert "Window" not in plan(checked) and "partial_count" in plan(checked)
    assert checked.filter(F.size("_failures") > 0).count() == 10000


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["new_keys"](spark, SF))
    assert p.count("FileScan") <= 2 and "Join" not in p  # one scan (printed once more as the initial plan)
    assert "PushedFilters: [IsNotNull(o_orderdate), IsNotNull(o_custkey)]" in p and "o_orderpriority" not in p
    p2 = plan(E.queries()["gold_device_rollup"](spark, SF))
    assert "EqualTo(l_returnflag,R)" in p2


def test_summary_top_k_has_no_whole_group_window(spark):
    p = plan(E.queries()["summary_by_group"](spark, SF))
    # the first ranking level is partitioned by (group, salt)
    assert "_salt" in p
