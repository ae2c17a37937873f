"""DQ-1..12 and UPS-1..6 / JOIN-2 / JOIN-7."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverline.operators import joins, upsert
from silverline.operators.contract import FAILURES, Contract, ContractError

SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("name", StringType(), False),
    StructField("kind", StringType(), True),
    StructField("n", LongType(), True),
])
C = Contract(SCHEMA, name="t", primary_key=["id"], unique=[["name"]], min_length={"name": 2},
             max_length={"name": 5}, enums={"kind": ["ASIC", "GPU"]}, non_negative=["n"],
             rules={"kind_needs_n": lambda: F.col("kind").isNull() | F.col("n").isNotNull()})


def test_each_rule_fires(spark):
    raw = spark.createDataFrame([
        ("1", "ok", "ASIC", "1"),      # good
        ("x", "ok2", None, None),       # id dtype
        ("3", None, None, None),        # name nullability
        ("4", "a", None, None),         # min_length
        ("5", "toolong", None, None),   # max_length
        ("6", "k6", "CPU", "1"),        # enum
        ("7", "k7", None, "-1"),        # min
        ("8", "k8", "GPU", None),       # row rule
        ("9", "d1", None, None), ("9", "d2", None, None),   # primary key
        ("10", "same", None, None), ("11", "same", None, None),  # unique name
    ], "id string, name string, kind string, n string")
    got = {(r.id, r.name): sorted(r[FAILURES]) for r in C.check(raw).collect()}
    assert got[(1, "ok")] == []
    assert got[(None, "ok2")] == ["id|dtype"]
    assert got[(3, None)] == ["name|nullability"]
    assert got[(4, "a")] == ["name|min_length"]
    assert got[(5, "toolong")] == ["name|max_length"]
    assert got[(6, "k6")] == ["kind|enum"]
    assert got[(7, "k7")] == ["n|min"]
    assert got[(8, "k8")] == ["rule|kind_needs_n"]
    assert got[(9, "d1")] == ["primary_key"] and got[(9, "d2")] == ["primary_key"]
    assert got[(10, "same")] == ["unique|name"] and got[(11, "same")] == ["unique|name"]
    good, bad = C.split(raw)
    assert good.count() == 1 and bad.count() == 11
    counts = {r.rule: r.n_failed for r in C.failure_counts(raw).collect()}
    assert counts["primary_key"] == 2 and counts["id|dtype"] == 1
    with pytest.raises(ContractError):
        C.validate(raw)


def _hundred(spark, bad: int):
    rows = [(str(i), f"n{i}", None, str(i)) for i in range(100)]
    for j in range(bad):
        rows[j] = (str(j), f"n{j}", "CPU", str(j))
    return spark.createDataFrame(rows, "id string, name string, kind string, n string")


def test_failure_budget(spark, tmp_path):  # DQ-9 / DQ-10 / SNK-3
    good, counts = C.enforce_budget(_hundred(spark, 1), 0.01, quarantine_path=str(tmp_path / "q1"))
    assert good.count() == 99 and counts["__failed_rows__"] == 1
    assert spark.read.parquet(str(tmp_path / "q1")).count() == 1
    with pytest.raises(ContractError) as e:
        C.enforce_budget(_hundred(spark, 2), 0.01, quarantine_path=str(tmp_path / "q2"))
    assert e.value.counts["kind|enum"] == 2
    assert spark.read.parquet(str(tmp_path / "q2")).count() == 2  # saved before raising


def test_assert_unique_and_checked_join(spark):  # DQ-11 / JOIN-1
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (1, "q")], "k int, w string")
    with pytest.raises(ValueError):
        joins.left_join_checked(a, b, ["k"])
    assert joins.left_join_checked(a, b.limit(1), ["k"]).count() == 2


CUR = [  # key, text, price, maybe
    (1, "same", 1.0, "x"),
    (2, "float-only", 1.0, "x"),
    (3, "null-null", 1.0, None),
    (4, "null-to-value", 1.0, None),
    (5, "text-change", 1.0, "x"),
    (6, "vanishes", 1.0, "x"),
]
NEW = [
    (1, "same", 1.0, "x"),
    (2, "float-only", 2.5, "x"),
    (3, "null-null", 1.0, None),
    (4, "null-to-value", 1.0, "v"),
    (5, "text-change!", 1.0, "x"),
    (7, "new", 1.0, None),
]
SCH = "k int, t string, price double, maybe string"


def _frames(spark):
    ts = dt.datetime(2024, 1, 1)
    cur = spark.createDataFrame(CUR, SCH).withColumns({"created_at": F.lit(ts).cast("timestamp_ntz"),
                                                       "updated_at": F.lit(ts).cast("timestamp_ntz")})
    return cur, spark.createDataFrame(NEW, SCH)


def test_changed_rows_null_safe_and_float_exclusion(spark):  # JOIN-2 / UPS-1
    cur, new = _frames(spark)
    assert sorted(r.k for r in upsert.changed_rows(new, cur).collect()) == [4, 5, 7]
    assert sorted(r.k for r in upsert.changed_rows(new, cur, exclude_float=False).collect()) == [2, 4, 5, 7]


def test_upsert_prune_summary_and_idempotence(spark, tmp_path):  # UPS-2..6
    cur, new = _frames(spark)
    as_of = "2024-06-01 00:00:00"
    nxt = {r.k: r for r in upsert.upsert(cur, new, ["k"], as_of).collect()}
    assert set(nxt) == {1, 2, 3, 4, 5, 6, 7}
    assert nxt[2].price == 1.0 and nxt[2].updated_at == dt.datetime(2024, 1, 1)  # float-only: not an update
    assert nxt[4].maybe == "v" and nxt[4].created_at == dt.datetime(2024, 1, 1)
    assert nxt[4].updated_at == dt.datetime(2024, 6, 1)
    assert nxt[7].created_at == nxt[7].updated_at == dt.datetime(2024, 6, 1)
    assert nxt[6].t == "vanishes"
    pruned = upsert.prune(upsert.upsert(cur, new, ["k"], as_of), new, ["k"])
    assert sorted(r.k for r in pruned.collect()) == [1, 2, 3, 4, 5, 7]
    summary = {r.change: r.n_rows for r in upsert.change_summary(cur, new, ["k"]).collect()}
    assert summary == {"unchanged": 3, "updated": 2, "inserted": 1, "absent": 1}
    # publish twice: the second run finds nothing to change and writes nothing
    p1 = str(tmp_path / "v1")
    assert upsert.publish(cur, new, ["k"], as_of, p1) is True
    again = spark.read.parquet(p1)
    assert upsert.publish(again, new, ["k"], "2024-07-01", str(tmp_path / "v2")) is False


def test_upsert_keeps_columns_missing_from_new(spark):
    cur, new = _frames(spark)
    slim = new.drop("maybe")
    nxt = {r.k: r for r in upsert.upsert(cur, slim, ["k"], "2024-06-01").collect()}
    assert nxt[5].maybe == "x" and nxt[5].t == "text-change!"


def test_lookups(spark):  # JOIN-5 / JOIN-6
    df = spark.createDataFrame([("H/s",), ("kH/s",), ("bogus",), (None,)], "u string")
    m = {"H/s": 1.0, "kH/s": 1000.0}
    got = [r[0] for r in df.select(joins.lookup_with_default(F.col("u"), {"H/s": "hash"})).collect()]
    assert got == ["hash", "kH/s", "bogus", None]
    assert [r[0] for r in df.select(joins.lookup_strict(F.col("u"), m)).collect()] == [1.0, 1000.0, None, None]
    with pytest.raises(Exception):
        df.select(joins.lookup_strict(F.col("u"), m, fail=True)).collect()
    ok = df.filter("u is null or u in ('H/s', 'kH/s')").select(joins.lookup_strict(F.col("u"), m, fail=True))
    assert [r[0] for r in ok.collect()] == [1.0, 1000.0, None]
    table = spark.createDataFrame([("H/s", "per second"), ("kH/s", "thousands")], "k string, v string")
    out = joins.lookup_table(df, "u", table, "k", "v", "label")
    assert sorted((r.u, r.label) for r in out.collect() if r.u) == [("H/s", "per second"), ("bogus", "bogus"),
                                                                    ("kH/s", "thousands")]


def test_normalize_hooks(spark):  # UDF-2: Column -> Column plug-ins around ENT-1
    from silverline.operators import entity
    df = spark.createDataFrame([(" sha256 ",)], "n string")
    out = df.select(entity.normalize_names(F.col("n"), pre=F.trim, post=F.upper).alias("x")).first().x
    assert out == "SHA256"  # "sha256" is not an alias spelling; post hook upper-cases
    out2 = df.select(entity.normalize_names(F.trim(F.col("n")), aliases={"X": ["sha256"]}).alias("x")).first().x
    assert out2 == "X"


def test_bucketed_snapshot_is_not_shuffled(spark, tmp_path):  # co-located upserts
    cur, new = _frames(spark)
    assert upsert.publish(cur, new, ["k"], "2024-06-01", str(tmp_path / "v1"), bucketed=("snap_v1", 4))
    snap = spark.table("snap_v1")
    nxt = upsert.upsert(snap, new.withColumn("t", F.concat("t", F.lit("+"))), ["k"], "2024-07-01")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")  # as many as buckets
    try:
        plan = nxt._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plan.count("Exchange hashpartitioning") == 1  # only the incoming rows move
    assert sorted(r.k for r in nxt.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_repeated_incoming_keys_leave_one_row_per_key(spark):  # UPS-2
    cur = spark.createDataFrame([(1, "a", 0), (9, "z", 0)], "k int, v string, sent int")
    new = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 2), (2, "w", 1), (3, "same", 1), (3, "same", 1)], cur.schema)
    nxt = upsert.upsert(cur, new, ["k"], "2024-06-01", order=["sent"]).collect()
    assert sorted((r.k, r.v) for r in nxt) == [(1, "new"), (2, "x"), (3, "same"), (9, "z")]
    summary = {r.change: r.n_rows for r in upsert.change_summary(cur, new, ["k"], order=["sent"]).collect()}
    assert summary == {"updated": 1, "inserted": 2, "absent": 1}


def test_totals_count_rows_and_reasons_together(spark):
    counts = C.totals(C.check(_hundred(spark, 2)))
    assert (counts["__rows__"], counts["__failed_rows__"], counts["kind|enum"]) == (100, 2, 2)


def test_totals_are_observed_while_the_rows_are_written(spark):
    """The input is evaluated once: an accumulator sees every row once."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(i, "x" if i % 5 else None) for i in range(100)] + [(7, "again")], "k long, v string").mapInPandas(look, "k long, v string")
    contract = Contract(StructType([StructField("k", LongType(), False), StructField("v", StringType(), False)]), rules={"small": lambda: F.col("k") < 90})
    good, counts = contract.enforce_budget(rows, 0.5)
    assert seen.value == 101 and counts == {"__rows__": 101, "__failed_rows__": 28, "v|nullability": 20, "rule|small": 10}
    assert good.count() == 73 and seen.value == 101
    assert counts == contract.totals(contract.check(rows))
    keyed = Contract(contract.schema, primary_key=["k"], unique=[["v"]])
    assert keyed.labels() == ["k|dtype", "k|nullability", "v|dtype", "v|nullability", "primary_key", "unique|v"]
    assert keyed.enforce_budget(rows, 1.0)[1] == keyed.totals(keyed.check(rows))
    empty, none = contract.enforce_budget(rows.limit(0))
    assert none == {"__rows__": 0, "__failed_rows__": 0} and empty.count() == 0
