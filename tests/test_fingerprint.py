"""JOIN-2 by fingerprints equals the plain null-safe anti join."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.operators import fingerprint, upsert

ROW = st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "", "a", "b"]), st.sampled_from([None, "", "a"]), st.sampled_from([None, 0.0, 1.0]))
COLUMNS = "k int, v string, w string, x double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=25), st.lists(ROW, max_size=25))
def test_equal_to_the_plain_join(spark, new, current):
    new, current = spark.createDataFrame(new, COLUMNS), spark.createDataFrame(current, COLUMNS)
    plain = rows(upsert.changed_rows(new, current))
    assert rows(fingerprint.changed_rows(new, current)) == plain == rows(fingerprint.changed_rows(new, current, confirm=False))


def test_rows_that_share_a_fingerprint_are_told_apart(spark):
    # hashes pass over null elements, so both rows have the same
    kind = "id int, a array<int>"
    new, current = spark.createDataFrame([(1, [1, None]), (1, [None, 1]), (2, [None])], kind), spark.createDataFrame([(1, [1, None]), (2, [])], kind)
    assert fingerprint.misses(fingerprint.fingerprinted(new, ["a", "id"]), fingerprint.fingerprinted(current, ["a", "id"])).count() == 0
    assert rows(fingerprint.changed_rows(new, current)) == rows(upsert.changed_rows(new, current)) == [(1, [None, 1]), (2, [None])]


def test_types_of_the_new_side_and_no_shared_columns(spark):
    new, current = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([(1, "a", 5)], "k int, v string, extra int")
    assert rows(fingerprint.changed_rows(new, current)) == [(2, "b")]
    assert rows(fingerprint.changed_rows(new, current.select("extra"))) == [(1, "a"), (2, "b")]


def test_only_fingerprints_are_joined_without_confirmation(spark):
    """The wide column is in no exchange: it is read beside the few misses."""
    wide = spark.range(2000).select("id", F.repeat(F.col("id").cast("string"), 50).alias("text"))
    changed = fingerprint.changed_rows(wide, wide.filter("id != 7"), confirm=False)
    assert rows(changed.select("id")) == [(7,)]
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
