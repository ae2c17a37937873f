"""UPS-6: a set of tables with one commit; silver and gold published twice."""

import os

import pytest

from silverline.operators import release
from silverline.operators.contract import ContractError
from silverline.plans.publish import publish_reports

SF = "/root/testdata/sf0.001"


def test_publish_twice_is_idempotent(spark, tmp_path):
    root, quarantine = f"{tmp_path}/set", f"{tmp_path}/quarantine"
    first = publish_reports(spark, SF, "2024-06-01", root, max_failed_fraction=0.2, quarantine_path=quarantine)
    assert set(first["silver"]) == {"inserted"} and set(first["gold"]) == {"inserted"}
    silver = release.read(spark, root, "silver")
    assert silver.filter("created_at is null or updated_at is null").count() == 0
    assert spark.read.parquet(quarantine).count() > 0  # negative balances fail the contract
    second = publish_reports(spark, SF, "2024-07-01", root, max_failed_fraction=0.2)
    assert set(second["silver"]) == {"unchanged"} and set(second["gold"]) == {"unchanged"}
    assert release.versions(spark, root) == [1]
    assert os.listdir(f"{root}/tables/silver") == os.listdir(f"{root}/tables/gold") == ["v000000001"]


def test_failure_budget_stops_publish(spark, tmp_path):
    with pytest.raises(ContractError):
        publish_reports(spark, SF, "2024-06-01", f"{tmp_path}/set")  # 1 % is the default
    assert release.versions(spark, f"{tmp_path}/set") == []


def _steps(spark, values, fail=False):
    def gold(made):
        if fail:
            raise RuntimeError("killed between the tables")
        return made["silver"].groupBy("k").count()

    silver = spark.createDataFrame(values, "k long, v string")
    return [release.Step("silver", ["k", "v"], lambda _: silver), release.Step("gold", ["k"], gold, prune_missing=True)]


def _seen(spark, root):
    return sorted(r.v for r in release.read(spark, root, "silver").collect()), {r.k: r["count"] for r in release.read(spark, root, "gold").collect()}


def test_a_run_that_dies_between_the_tables_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path)
    release.publish(spark, root, "2024-06-01", _steps(spark, [(1, "a")]))
    old = _seen(spark, root)
    assert old == (["a"], {1: 1})
    with pytest.raises(RuntimeError, match="killed"):
        release.publish(spark, root, "2024-06-02", _steps(spark, [(1, "a"), (1, "b"), (2, "c")], fail=True))
    assert os.path.exists(f"{root}/tables/silver/v000000002") and release.versions(spark, root) == [1]
    assert _seen(spark, root) == old
    # the rerun takes over, whatever the dead run left
    summary = release.publish(spark, root, "2024-06-03", _steps(spark, [(1, "a"), (1, "b"), (3, "d")]))
    assert summary["silver"] == {"inserted": 2, "unchanged": 1} and summary["gold"] == {"inserted": 1, "updated": 1}
    assert _seen(spark, root) == (["a", "b", "d"], {1: 2, 3: 1})
    # the first version can still be read
    assert release.read(spark, root, "silver", 1).count() == 1
    with pytest.raises(KeyError):
        release.read(spark, root, "other")


def test_a_version_published_meanwhile_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    release.publish(spark, root, "2024-06-01", _steps(spark, [(1, "a")]))
    with pytest.raises(RuntimeError, match="meanwhile"):
        release._commit(spark, root, release.Version(1, {"silver": "elsewhere"}))
    assert _seen(spark, root) == (["a"], {1: 1})


def test_an_empty_first_table_is_published(spark, tmp_path):
    root = str(tmp_path)
    release.publish(spark, root, "2024-06-01", _steps(spark, []))
    assert _seen(spark, root) == ([], {}) and release.versions(spark, root) == [1]
