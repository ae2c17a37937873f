"""Readers, writers and frame-wide column operators over files written from
the driver's tables (SRC-4..11, SNK-1..4, PRJ-4..6, PRJ-13/14, FLT-12, JOIN-1,
DQ-7, DQ-9..11, UPS-3): each query writes into a fresh work folder of the
shared checkpoint directory and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverline.operators import clean, joins, numbering, upsert
from silverline.plans import entities as EN
from silverline.plans import maintenance as M
from silverline.plans import reports as R
from silverline.plans.registry import ORACLE, T, register
from silverline.sources import io
from silverline.sources import lookup
from silverline.sources import variants as V
from silverline.streaming.jobs import work_dir

ORDER_RECORD = "struct<`Order Key`:bigint,Status:string,logo:string,`Total (USD)`:double>"


@register("json_records", """
select o_orderkey as order_id, o_orderstatus as status, case when o_orderkey % 4 <> 0 then '/' || o_orderkey || '.png' end as logo_url,
  o_totalprice as total_usd from orders
""")
def q_json_records(spark, sf):
    """Nested documents, one per customer, read with a schema down to their
    records; columns renamed by function, by mapping and by suffix."""
    out = work_dir(spark, "json")
    record = F.struct(F.col("o_orderkey").alias("Order Key"), F.col("o_orderstatus").alias("Status"),
                      F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".png"))).alias("logo"),
                      F.col("o_totalprice").alias("Total (USD)"))
    # a document holds orders of one customer, up to about 64; a customer with more has more documents
    o = T(spark, sf, "orders")
    sizes = o.groupBy(F.col("o_custkey").alias("customer")).agg(F.count(F.lit(1)).alias("n_orders"))
    part = F.pmod(F.xxhash64("o_orderkey"), F.ceil(F.col("n_orders") / 64))
    docs = o.join(sizes, F.col("o_custkey").eqNullSafe(F.col("customer"))).groupBy("customer", part).agg(F.collect_list(record).alias("items"))
    nested = F.struct(F.struct(F.struct("items").alias("context"), F.lit(1).alias("page")).alias("result"))
    docs.select(F.to_json(nested).alias("value")).write.text(f"{out}/docs")
    schema = StructType.fromDDL(f"result struct<context:struct<items:array<{ORDER_RECORD}>>>")
    rows = clean.rename_all(io.read_json_records(spark, f"{out}/docs", schema, "result.context.items", multiline=False))
    return clean.rename_with_suffix(rows.withColumnsRenamed({"order_key": "order_id"}), ["logo"], "_url")


@register("json_inferred", """
select event_id, cast(json_extract(props, '$.k') as bigint) as k, case when event_id % 1000 = 7 then 0.5 end as late from events
""")
def q_json_inferred(spark, sf):
    """Records with a key that few of them have: inference scans them all."""
    out = work_dir(spark, "inferred")
    k = F.from_json("props", "k BIGINT")["k"]
    late = F.when(F.col("event_id") % 1000 == 7, F.lit(0.5))
    T(spark, sf, "events").select(F.to_json(F.struct("event_id", k.alias("k"), late.alias("late"))).alias("value")).write.text(f"{out}/lines")
    return io.read_json_records(spark, f"{out}/lines", multiline=False, full_scan_inference=True).select("event_id", "k", "late")


@register("table_twins", """
select t.twin, p_partkey, p_name, case when t.twin = 'csv' then '[' || p_size || ',' || p_size + 1 || ']' end as sizes_json, p_size as first_size
from part, (values ('csv'), ('parquet')) t(twin)
""")
def q_table_twins(spark, sf):
    """CSV and Parquet twins of one frame with a nested column, both read back."""
    out = work_dir(spark, "twins")
    part = T(spark, sf, "part").select("p_partkey", "p_name", F.array(F.col("p_size"), F.col("p_size") + 1).alias("sizes"))
    io.write_tables(part, out, "part")
    csv = io.read_csv(spark, f"{out}/part.csv", StructType.fromDDL("p_partkey bigint, p_name string, sizes string"))
    csv = csv.select(F.lit("csv").alias("twin"), "p_partkey", "p_name", F.col("sizes").alias("sizes_json"), F.from_json("sizes", "array<bigint>")[0].alias("first_size"))
    parquet = io.read_parquet(spark, f"{out}/part.parquet", part.schema)
    return csv.unionByName(parquet.select(F.lit("parquet").alias("twin"), "p_partkey", "p_name", F.lit(None).cast("string").alias("sizes_json"),
                                          F.col("sizes")[0].cast("bigint").alias("first_size")))


@register("page_files", """
select cast(n_nationkey as bigint) as nation, md5('<h1>' || n_name || '</h1>' || chr(10) || 'line') as html_md5 from nation
""")
def q_page_files(spark, sf):
    """One stored page per nation, read as whole files from one folder tree."""
    out = work_dir(spark, "pages")
    html = F.concat(F.lit("<h1>"), F.col("n_name"), F.lit("</h1>\nline"))
    T(spark, sf, "nation").select("n_nationkey", html.alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(f"{out}/html")
    pages = io.read_pages(spark, f"{out}/html/*", "*.txt")
    return pages.select(F.regexp_extract("url", r"n_nationkey=(\d+)/", 1).cast("bigint").alias("nation"), F.md5(F.regexp_replace("html", r"\n\z", "")).alias("html_md5"))


@register("ragged_columns", """
select o_orderkey, o_orderstatus as reported_status, case when o_custkey % 3 = 0 then o_orderpriority end as reported_priority,
  cast(null as varchar) as reported_absent from orders
""")
def q_ragged_columns(spark, sf):
    """Maps with differing keys to one column per wanted key, after a row-count guard."""
    o = io.require_min_rows(T(spark, sf, "orders"), 100, "orders")
    kv = F.map_concat(F.create_map(F.lit("status"), F.col("o_orderstatus")),
                      F.when(F.col("o_custkey") % 3 == 0, F.create_map(F.lit("priority"), F.col("o_orderpriority"))).otherwise(F.create_map().cast("map<string,string>")))
    return o.select("o_orderkey", kv.alias("kv")).select("o_orderkey", *io.ragged_to_columns(F.col("kv"), ["status", "priority", "absent"], "reported_"))


@register("quarantined_parties", f"""
select source_site, entity_source_id, failures, n.total, n.failed from ({ORACLE['silver_parties']}) p,
  (select count(*) as total, count(*) filter (not passed) as failed from ({ORACLE['silver_parties']})) n where not passed
""")
def q_quarantined_parties(spark, sf):
    """The failure budget of the silver contract: failed rows as quarantined, with the totals that it counted."""
    from silverline.operators import entity
    from silverline.operators.contract import FAILURES

    out = work_dir(spark, "quarantine")
    st = entity.canonical_names(EN.stacked_parties(spark, sf), "reported_group_name", "group_name")
    _, counts = R.SILVER_CONTRACT.enforce_budget(st, 0.2, f"{out}/failed")
    return io.read_parquet(spark, f"{out}/failed").select(
        "source_site", "entity_source_id", F.array_join(F.array_sort(FAILURES), ";").alias("failures"),
        F.lit(counts["__rows__"]).cast("bigint").alias("total"), F.lit(counts["__failed_rows__"]).cast("bigint").alias("failed"))


@register("join_checked", """
select s_suppkey, s_name, n_name, r_name from supplier left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
""")
def q_join_checked(spark, sf):
    """A left join after checking the key on both sides, and a validated contract on its result."""
    from silverline.operators.contract import Contract

    nations = joins.left_join_checked(T(spark, sf, "nation").withColumn("k", F.col("n_nationkey")),
                                      T(spark, sf, "region").join(T(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("r")), F.col("r") == F.col("r_regionkey"))
                                      .select(F.col("n_nationkey").alias("k"), "r_name"), ["k"])
    joined = T(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "s_name", "n_name", "r_name")
    return Contract(joined.schema, name="suppliers", primary_key=["s_suppkey"]).validate(joined)


@register("cast_like", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def q_cast_like(spark, sf):
    """Texts cast back to another frame's types, and a frame conformed to a schema."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    texts = o.select(*[F.col(c).cast("string").alias(c) for c in ("o_totalprice", "o_orderkey", "o_orderstatus", "o_custkey")])
    return clean.conform(clean.cast_like(texts, o), o.schema)


@register("published_twice", f"select o_orderkey, o_orderstatus, o_totalprice, timestamp '{M.UPSERT_AS_OF}' as updated_at, true as first_write, false as second_write from orders",
          ts=("updated_at",))
def q_published_twice(spark, sf):
    """The same rows published twice: the second time nothing changes and nothing is written."""
    out = work_dir(spark, "twice")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stamps = {c: F.lit(None).cast("timestamp_ntz") for c in upsert.AUDIT_COLUMNS}
    first = upsert.publish(o.limit(0).withColumns(stamps), o, ["o_orderkey"], M.UPSERT_AS_OF, f"{out}/v1")
    v1 = io.read_parquet(spark, f"{out}/v1")
    second = upsert.publish(v1, o, ["o_orderkey"], "2024-07-01 00:00:00", f"{out}/v2")
    return v1.select("o_orderkey", "o_orderstatus", "o_totalprice", "updated_at", F.lit(first).alias("first_write"), F.lit(second).alias("second_write"))


@register("preview", """
select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey limit 10
""", ts=("o_orderdate",))
def q_preview(spark, sf):
    """The newest rows written as a preview."""
    out = work_dir(spark, "preview")
    newest = T(spark, sf, "orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10)
    io.write_parquet(newest, f"{out}/newest")
    return io.read_parquet(spark, f"{out}/newest")


def _documents_of_many_types(spark, sf, out: str):
    """One document per order; its total is a number, a text, an object or not there."""
    k, total = F.col("o_orderkey") % 4, F.col("o_totalprice").cast("long").cast("string")
    value = (F.when(k == 0, total).when(k == 1, F.concat(F.lit('"'), total, F.lit('"'))).when(k == 2, F.concat(F.lit('{"amount": '), total, F.lit("}"))))
    tags = F.when(F.col("o_orderkey") % 5 == 0, "null").otherwise(F.concat(F.lit('["'), F.col("o_orderstatus"), F.lit('", '), F.substring("o_orderpriority", 1, 1), F.lit("]")))
    text = F.concat(F.lit('{"id": '), F.col("o_orderkey").cast("string"), F.coalesce(F.concat(F.lit(', "total": '), value), F.lit("")), F.lit(', "tags": '), tags, F.lit("}"))
    T(spark, sf, "orders").select(text.alias("value")).write.text(out)


@register("variant_records", """
select o_orderkey as order_id, ['BIGINT', 'STRING', 'OBJECT', null][o_orderkey % 4 + 1] as kind,
  case when o_orderkey % 4 < 3 then cast(trunc(o_totalprice) as bigint) end as total,
  case when o_orderkey % 5 <> 0 then o_orderstatus || ',' || substr(o_orderpriority, 1, 1) end as tags from orders
""")
def q_variant_records(spark, sf):
    """SRC-4, PRJ-11: documents whose field changes its type, read without a schema and parsed once."""
    out = work_dir(spark, "variants")
    _documents_of_many_types(spark, sf, f"{out}/lines")
    d = V.read_variants(spark, f"{out}/lines").filter("bad is null")
    return d.select(V.field("document", "$.id", "bigint").alias("order_id"), V.kind("document", "$.total").alias("kind"),
                    F.coalesce(V.field("document", "$.total", "bigint"), V.field("document", "$.total.amount", "bigint")).alias("total"),
                    F.array_join(V.field("document", "$.tags", "array<string>"), ",").alias("tags"))


@register("variant_elements", """
select o_orderkey as order_id, i as place, case i when 0 then 'STRING' when 1 then 'BIGINT' end as kind,
  case i when 0 then o_orderstatus when 1 then substr(o_orderpriority, 1, 1) end as element
from orders left join (values (0), (1)) t(i) on o_orderkey % 5 <> 0
""")
def q_variant_elements(spark, sf):
    """SRC-5, PRJ-12: elements of different types of one list, each as what it is."""
    out = work_dir(spark, "variants")
    _documents_of_many_types(spark, sf, f"{out}/lines")
    d = V.read_variants(spark, f"{out}/lines").withColumn("order_id", V.field("document", "$.id", "bigint"))
    return V.records(d, "document", "$.tags", keep=["order_id"]).select("order_id", "place", V.kind("record").alias("kind"), V.field("record", "$", "string").alias("element"))


@register("variant_field_types", """
with kinds as (
  select 'id' as field, 'BIGINT' as kind, false as conflict from orders
  union all select 'total', ['BIGINT', 'STRING', 'OBJECT'][o_orderkey % 4 + 1], true from orders where o_orderkey % 4 < 3
  union all select 'tags', case when o_orderkey % 5 = 0 then 'VOID' else 'ARRAY' end, false from orders)
select field, kind, count(*) as n_rows, conflict from kinds group by field, kind, conflict
""")
def q_variant_field_types(spark, sf):
    """SRC-7: what each field of the documents is, and where that conflicts."""
    out = work_dir(spark, "variants")
    _documents_of_many_types(spark, sf, f"{out}/lines")
    return V.field_types(V.read_variants(spark, f"{out}/lines"), "document")


@register("order_batches", """
with placed as (select o_orderkey, row_number() over (order by o_orderdate desc, o_orderkey) - 1 as n from orders)
select o_orderkey, n // 1000 as batch, cast(n % 1000 as integer) as place, least(1000, (select count(*) from orders) - n // 1000 * 1000) as batch_size from placed
""")
def q_order_batches(spark, sf):
    """SRT-7: orders, newest first, written in batches of exactly 1000 rows and read back."""
    out = work_dir(spark, "batches")
    numbering.write_batches(T(spark, sf, "orders").select("o_orderkey", "o_orderdate"), 1000, [F.desc("o_orderdate"), "o_orderkey"], f"{out}/orders")
    rows = spark.read.parquet(f"{out}/orders").select("o_orderkey", F.col("batch").cast("long").alias("batch"), "place")
    return rows.join(rows.groupBy("batch").agg(F.count(F.lit(1)).alias("batch_size")), "batch").select("o_orderkey", "batch", "place", "batch_size")


@register("part_lookup", """
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
where l_partkey in (select p_partkey from part order by p_retailprice desc, p_partkey limit 20) or l_orderkey in (select max(o_orderkey) from orders)
""")
def q_part_lookup(spark, sf):
    """SRC-1 / FLT-2: line items written once for lookups, sorted by order with
    Bloom filters on the part; those of the twenty dearest parts and of the last order."""
    path = f"{work_dir(spark, 'lookup')}/lineitem"
    lookup.write_lookup(T(spark, sf, "lineitem"), path, ["l_orderkey", "l_linenumber"], bloom=["l_partkey"])
    lines = io.read_parquet(spark, path).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    dearest = T(spark, sf, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)
    last = T(spark, sf, "orders").agg(F.max("o_orderkey").alias("o_orderkey"))
    by_part = lookup.lookup_keys(lines, "l_partkey", dearest, "p_partkey")
    by_order = lookup.lookup_keys(lines, "l_orderkey", last, "o_orderkey")
    return by_part.unionByName(by_order).distinct()
