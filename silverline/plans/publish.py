"""UPS-6 end to end: silver parties and the gold rollup published as one set
of keyed snapshots (validate -> upsert -> optional prune -> write all versions
-> commit one manifest).  A failed run leaves the set that readers see intact
and a rerun takes over.  The query ``published_gold`` runs it in a fresh work
folder and returns the gold table; ``published_set`` returns what the manifests
of three runs name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from silverline.functions import arrays as A
from silverline.operators import digest, entity, release, rollup
from silverline.operators.contract import Contract
from silverline.plans import entities as EN
from silverline.plans import maintenance as MT
from silverline.plans import reports as R
from silverline.plans.registry import ORACLE, T, dates_as_text, register
from silverline.streaming.jobs import work_dir

GOLD_CONTRACT = Contract(
    name="gold_groups",
    schema=StructType([
        StructField("group_name", StringType(), False),
        StructField("source_sites_json", StringType(), False),
        StructField("source_tables_json", StringType(), False),
        StructField("entity_count", LongType(), False),
        # groups of parties without activity have no first and last member
        StructField("earliest_created_at", DateType(), True),
        StructField("latest_created_at", DateType(), True),
        StructField("earliest_entity", StringType(), True),
        StructField("latest_entity", StringType(), True),
        StructField("balance_total", DoubleType(), False),
        StructField("segments_json", StringType(), False),
        StructField("device_count", LongType(), True),
        StructField("earliest_device_date", DateType(), True),
        StructField("latest_device_date", DateType(), True),
        StructField("reported_aliases_json", StringType(), False),
    ]),
    primary_key=["group_name"],
    min_length={"group_name": 1, "source_sites_json": 2, "earliest_entity": 1, "latest_entity": 1},
    max_length={"group_name": 100},
    non_negative=["entity_count", "device_count"],
    rules={"aliases_not_empty": lambda: A.json_array_not_empty("reported_aliases_json")},
)


def publish_reports(spark: SparkSession, sf_dir: str, as_of: str, root: str, max_failed_fraction: float = 0.01,
                    quarantine_path: str | None = None) -> dict[str, dict[str, int]]:
    """Silver: stack -> canonical names -> contract with a failure budget
    (failed rows quarantined) -> upsert into the silver snapshot.  Gold:
    rollup -> contract (raises on any failure) -> upsert + prune.  Both are
    committed together under ``root``.  Returns the change summary of both; a
    table whose rows did not change is not rewritten."""
    accepted: dict[str, DataFrame] = {}

    def silver(_) -> DataFrame:
        raw = entity.canonical_names(EN.stacked_parties(spark, sf_dir), "reported_group_name", "group_name")
        accepted["silver"] = R.SILVER_CONTRACT.enforce_budget(raw, max_failed_fraction, quarantine_path)[0]
        return accepted["silver"]

    def gold(_) -> DataFrame:
        # gold counts what silver accepted in this run, and nothing else
        rows = rollup.gold_join(EN.gold_entities(spark, sf_dir, accepted["silver"]), EN.gold_devices(spark, sf_dir), "group_name")
        return GOLD_CONTRACT.validate(rows.select(*GOLD_CONTRACT.columns))

    return release.publish(spark, root, as_of, [
        release.Step("silver", ["source_site", "entity_source_id"], silver), release.Step("gold", ["group_name"], gold, prune_missing=True)])


PUBLISHED_AS_OF = "2024-06-01 00:00:00"


def _sql_published() -> str:
    """The gold join's SQL over the parties that pass the silver query's SQL."""
    silver = ORACLE["silver_parties"]
    gold = ORACLE["gold_join"].replace("active as (select s.*, a.created_at from named s left join (", f"""passed as (
  select source_site, entity_source_id from ({silver}) where passed),
active as (select s.*, a.created_at from (select named.* from named semi join passed using (source_site, entity_source_id)) s left join (""")
    return f"select *, timestamp '{PUBLISHED_AS_OF}' as created_at, timestamp '{PUBLISHED_AS_OF}' as updated_at from ({gold})"


@register("published_gold", _sql_published(), ts=("created_at", "updated_at"))
def q_published_gold(spark, sf):
    """UPS-6: silver with its failure budget, then gold from what silver accepted, as published."""
    out = work_dir(spark, "publish")
    publish_reports(spark, sf, PUBLISHED_AS_OF, f"{out}/set", max_failed_fraction=0.2, quarantine_path=f"{out}/quarantine")
    gold = release.read(spark, f"{out}/set", "gold")
    stamps = ["created_at", "updated_at"]
    return dates_as_text(gold.select(*[c for c in gold.columns if c not in stamps], *stamps))


@register("published_set", f"""
with {MT._SQL_SNAP},
totals as (select 1 as version, o_custkey, count(*) as n_orders from cur where o_custkey is not null group by o_custkey
  union all select 2, o_custkey, count(*) from nxt where o_custkey is not null group by o_custkey),
sets as (
  select 1 as version, 'orders' as name, 1 as written, count(*) as n_rows, cast(sum(o_orderkey) as bigint) as checksum from cur
  union all select 2, 'orders', 2, count(*), cast(sum(o_orderkey) as bigint) from nxt
  union all select version, 'totals', version, count(*), cast(sum(o_custkey * n_orders) as bigint) from totals group by version
  union all select v, 'customers', 1, count(*), cast(sum(c_custkey) as bigint) from customer, (values (1), (2)) t(v) group by v)
select version, name, written, n_rows, checksum from sets
""")
def q_published_set(spark, sf):
    """UPS-6: three runs over orders, totals made from what the set holds, and
    customers that never change; the third run changes nothing.  What every
    committed version names."""
    root = work_dir(spark, "set")
    customers = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")

    def steps(orders):
        return [release.Step("customers", ["c_custkey"], lambda _: customers), release.Step("orders", ["o_orderkey"], lambda _: orders),
                release.Step("totals", ["o_custkey"], lambda made: made["orders"].filter("o_custkey is not null").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")), prune_missing=True)]

    release.publish(spark, root, MT.SNAPSHOT_TS, steps(MT.current_snapshot(spark, sf).drop("created_at", "updated_at")))
    for _ in range(2):
        release.publish(spark, root, MT.UPSERT_AS_OF, steps(MT.incoming(spark, sf)))
    checksum = {"orders": F.col("o_orderkey"), "totals": F.col("o_custkey") * F.col("n_orders"), "customers": F.col("c_custkey")}
    held = None
    for number in release.versions(spark, root):
        for name, value in checksum.items():
            one = release.read(spark, root, name, number).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(value).cast("long").alias("checksum"))
            one = one.select(F.lit(number).alias("version"), F.lit(name).alias("name"), "n_rows", "checksum")
            held = one if held is None else held.unionByName(one)
    written = F.regexp_extract("path", r"v0*(\d+)$", 1).cast("int").alias("written")
    return release.manifests(spark, root).select("version", "name", written).join(held, ["version", "name"])


@register("published_by_digest", f"""
with {MT._SQL_SNAP},
rows as (select * from cur where o_orderkey % 16 >= 4 union all select * from nxt where o_orderkey % 16 < 4)
select o_orderkey % 16 as bucket, case when o_orderkey % 16 < 4 then 2 else 1 end as version, count(*) as n_rows,
  cast(sum(o_orderkey) as bigint) as checksum, count(*) filter (updated_at = timestamp '{MT.UPSERT_AS_OF}') as n_touched
from rows group by 1, 2
""")
def q_published_by_digest(spark, sf):
    """UPS-3: orders published by bucket digests; the second run alters a
    quarter of the buckets and rewrites these alone, the third changes nothing.
    What each bucket of the last version holds, and which version wrote it."""
    root, by = work_dir(spark, "digest"), F.pmod("o_orderkey", F.lit(16)).cast("int")
    first = MT.current_snapshot(spark, sf).drop("created_at", "updated_at")
    second = first.filter(by >= 4).unionByName(MT.incoming(spark, sf).filter(by < 4))
    digest.publish(spark, root, first, ["o_orderkey"], MT.SNAPSHOT_TS, bucket=by)
    for _ in range(2):
        after = digest.publish(spark, root, second, ["o_orderkey"], MT.UPSERT_AS_OF, bucket=by)
    versions = spark.createDataFrame([(b, v) for b, (v, _) in after.buckets.items()], "bucket int, version int")  # one row per bucket
    held = digest.read(spark, root).groupBy(by.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").cast("long").alias("checksum"),
        F.count_if(F.col("updated_at") == F.lit(MT.UPSERT_AS_OF).cast("timestamp_ntz")).alias("n_touched"))
    return versions.join(held, "bucket").select(F.col("bucket").cast("long").alias("bucket"), "version", "n_rows", "checksum", "n_touched")
