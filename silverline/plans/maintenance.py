"""Contracts, key checks, change detection, upsert / prune and the new-key
report (DQ-*, JOIN-2/3/4/7, UPS-*, RPT-10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from silverline.functions import dates as D
from silverline.operators import fingerprint, joins, upsert
from silverline.operators.contract import FAILURES, Contract
from silverline.plans.registry import AS_OF, T, dates_as_text, register

# ---------------------------------------------------------------------------
# DQ-1..9: a contract over documents + labels
# ---------------------------------------------------------------------------
LANGS = ["en", "fr", "de", "es"]
DOC_CONTRACT = Contract(
    name="labelled_documents",
    schema=StructType([
        StructField("doc_id", LongType(), False),
        StructField("text", StringType(), False),
        StructField("lang", StringType(), False),
        StructField("source", StringType(), True),
        StructField("n_chars", LongType(), True),
        StructField("quality", IntegerType(), False),
        StructField("toxic", IntegerType(), True),
    ]),
    primary_key=["doc_id"],
    unique=[["text"]],
    digest_keys=["text"],
    min_length={"text": 1, "source": 4},
    max_length={"text": 20000, "source": 4},
    enums={"lang": LANGS},
    non_negative=["n_chars"],
    rules={"n_chars_matches": lambda: F.col("n_chars") == F.char_length("text")},
)


def labelled_documents(spark, sf):
    return T(spark, sf, "documents").join(T(spark, sf, "labels"), "doc_id", "left")


_SQL_CHECKED = f"""with d as (select d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  from documents d left join labels l using (doc_id)),
f as (select doc_id, list_filter([
  case when doc_id is null then 'doc_id|nullability' end,
  case when text is null then 'text|nullability' end,
  case when length(text) < 1 then 'text|min_length' end,
  case when length(text) > 20000 then 'text|max_length' end,
  case when lang is null then 'lang|nullability' end,
  case when lang is not null and lang not in ({', '.join(f"'{x}'" for x in LANGS)}) then 'lang|enum' end,
  case when length(source) < 4 then 'source|min_length' end,
  case when length(source) > 4 then 'source|max_length' end,
  case when n_chars < 0 then 'n_chars|min' end,
  case when quality is null then 'quality|nullability' end,
  case when not coalesce(n_chars = length(text), false) then 'rule|n_chars_matches' end,
  case when doc_id is not null and count(*) over (partition by doc_id) > 1 then 'primary_key' end,
  case when text is not null and count(*) over (partition by text) > 1 then 'unique|text' end
  ], lambda x: x is not null) as fl from d)"""


@register("contract_split", f"""{_SQL_CHECKED}
select doc_id, cast(len(fl) as bigint) as n_failures, array_to_string(list_sort(fl), ';') as failures,
  len(fl) = 0 as passed from f
""")
def q_contract_split(spark, sf):
    checked = DOC_CONTRACT.check(labelled_documents(spark, sf))
    return checked.select("doc_id", F.size(FAILURES).cast("bigint").alias("n_failures"),
                          F.array_join(F.array_sort(FAILURES), ";").alias("failures"),
                          (F.size(FAILURES) == 0).alias("passed"))


@register("contract_summary", f"""{_SQL_CHECKED}
select rule, count(*) as n_failed from (select unnest(fl) as rule from f) group by rule
""")
def q_contract_summary(spark, sf):
    return DOC_CONTRACT.failure_counts(labelled_documents(spark, sf))


@register("pk_violations", """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by l_orderkey, l_linenumber
having count(*) > 1
""")
def q_pk_violations(spark, sf):
    return joins.duplicate_keys(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------
# JOIN-2 / UPS-1..5 / JOIN-7: orders as the stored snapshot vs an altered copy
# ---------------------------------------------------------------------------
SNAPSHOT_TS = "2024-01-01 00:00:00"
UPSERT_AS_OF = "2024-06-01 00:00:00"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def current_snapshot(spark, sf):
    o = T(spark, sf, "orders").select(*ORDER_COLS)
    k = F.col("o_orderkey") % 10
    return o.withColumns({
        "o_orderstatus": F.when(k.isin(2, 3), F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")),
        "created_at": F.lit(SNAPSHOT_TS).cast("timestamp_ntz"),
        "updated_at": F.lit(SNAPSHOT_TS).cast("timestamp_ntz"),
    })


def incoming(spark, sf):
    """Altered copy: priority edit (0), float-only edit (1), NULL kept NULL
    (2), NULL -> value (3), re-keyed = new key + vanished key (4), row gone
    (5), value -> NULL (6)."""
    o = T(spark, sf, "orders").select(*ORDER_COLS)
    k = F.col("o_orderkey") % 10
    o = o.filter(k != 5)
    return o.withColumns({
        "o_orderpriority": F.when(k == 0, F.concat("o_orderpriority", F.lit("*"))).otherwise(F.col("o_orderpriority")),
        "o_totalprice": F.when(k == 1, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(k == 2, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")),
        "o_custkey": F.when(k == 6, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")),
        "o_orderkey": F.when(k == 4, F.col("o_orderkey") + 10_000_000).otherwise(F.col("o_orderkey")),
    })


_SQL_SNAP = f"""cur as (select o_orderkey, o_custkey,
    case when o_orderkey % 10 in (2, 3) then null else o_orderstatus end as o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority,
    timestamp '{SNAPSHOT_TS}' as created_at, timestamp '{SNAPSHOT_TS}' as updated_at from orders),
new as (select case when o_orderkey % 10 = 4 then o_orderkey + 10000000 else o_orderkey end as o_orderkey,
    case when o_orderkey % 10 = 6 then null else o_custkey end as o_custkey,
    case when o_orderkey % 10 = 2 then null else o_orderstatus end as o_orderstatus,
    case when o_orderkey % 10 = 1 then o_totalprice + 1.0 else o_totalprice end as o_totalprice,
    o_orderdate,
    case when o_orderkey % 10 = 0 then o_orderpriority || '*' else o_orderpriority end as o_orderpriority
  from orders where o_orderkey % 10 <> 5),
chg as (select * from new n where not exists (select 1 from cur c where
    c.o_custkey is not distinct from n.o_custkey and c.o_orderdate is not distinct from n.o_orderdate
    and c.o_orderkey is not distinct from n.o_orderkey and c.o_orderpriority is not distinct from n.o_orderpriority
    and c.o_orderstatus is not distinct from n.o_orderstatus)),
nxt as (select coalesce(c.o_orderkey, u.o_orderkey) as o_orderkey,
    case when u.o_orderkey is not null then u.o_custkey else c.o_custkey end as o_custkey,
    case when u.o_orderkey is not null then u.o_orderstatus else c.o_orderstatus end as o_orderstatus,
    case when u.o_orderkey is not null then u.o_totalprice else c.o_totalprice end as o_totalprice,
    case when u.o_orderkey is not null then u.o_orderdate else c.o_orderdate end as o_orderdate,
    case when u.o_orderkey is not null then u.o_orderpriority else c.o_orderpriority end as o_orderpriority,
    coalesce(c.created_at, timestamp '{UPSERT_AS_OF}') as created_at,
    case when u.o_orderkey is not null then timestamp '{UPSERT_AS_OF}' else c.updated_at end as updated_at
  from cur c full outer join chg u on c.o_orderkey = u.o_orderkey)"""


@register("changed_rows", f"with {_SQL_SNAP} select * from chg", ts=("o_orderdate",))
def q_changed_rows(spark, sf):
    return upsert.changed_rows(incoming(spark, sf), current_snapshot(spark, sf))


# Documents as wide rows without a key: nulls, copies, edits deep inside long texts.
_SQL_DOC_ROWS = """cur as (select text, case when doc_id % 7 = 0 then null else lang end as lang, source from documents),
new as (select doc_id, case when doc_id % 5 = 0 then text || '.' when doc_id % 11 = 0 then null else text end as text,
    case when doc_id % 7 = 0 and doc_id % 2 = 0 then null else lang end as lang, source from documents
  union all select -1 - doc_id, text, lang, source from documents)"""


@register("changed_texts", f"""with {_SQL_DOC_ROWS}
select doc_id, md5(text) as text_md5, lang, source from new n where not exists (select 1 from cur c where
  c.text is not distinct from n.text and c.lang is not distinct from n.lang and c.source is not distinct from n.source)
""")
def q_changed_texts(spark, sf):
    """JOIN-2 by fingerprints over whole texts, every row of which arrives twice, once altered."""
    docs, k = T(spark, sf, "documents").select("doc_id", "text", "lang", "source"), F.col("doc_id")
    none = F.lit(None).cast("string")
    cur = docs.withColumn("lang", F.when(k % 7 == 0, none).otherwise(F.col("lang"))).drop("doc_id")
    text = F.when(k % 5 == 0, F.concat("text", F.lit("."))).when(k % 11 == 0, none).otherwise(F.col("text"))
    altered = docs.withColumns({"text": text, "lang": F.when((k % 7 == 0) & (k % 2 == 0), none).otherwise(F.col("lang"))})
    new = altered.unionByName(docs.withColumn("doc_id", -1 - k))
    return fingerprint.changed_rows(new, cur).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


@register("upsert_snapshot", f"with {_SQL_SNAP} select * from nxt", ts=("o_orderdate", "created_at", "updated_at"))
def q_upsert_snapshot(spark, sf):
    cur, new = current_snapshot(spark, sf).withColumn("sent", F.lit(2)), incoming(spark, sf).withColumn("sent", F.lit(2))
    # a third of the keys arrive twice, an older state beside the last one
    stale = new.filter(F.col("o_orderkey") % 3 == 0).withColumns({"o_orderstatus": F.lit("?"), "sent": F.lit(1)})
    return upsert.upsert(cur, new.unionByName(stale), ["o_orderkey"], UPSERT_AS_OF, order=["sent"]).drop("sent")


@register("prune_snapshot", f"with {_SQL_SNAP} select * from nxt where o_orderkey in (select o_orderkey from new)",
          ts=("o_orderdate", "created_at", "updated_at"))
def q_prune_snapshot(spark, sf):
    cur, new = current_snapshot(spark, sf), incoming(spark, sf)
    return upsert.upsert(cur, new, ["o_orderkey"], UPSERT_AS_OF, prune_missing=True)


@register("upsert_summary", f"""with {_SQL_SNAP}
select change, count(*) as n_rows from (
  select case when n.o_orderkey is null then 'absent' when c.o_orderkey is null then 'inserted'
              when h.o_orderkey is not null then 'updated' else 'unchanged' end as change
  from (select o_orderkey from new) n left join (select o_orderkey from chg) h on n.o_orderkey = h.o_orderkey
  full outer join (select distinct o_orderkey from cur) c on n.o_orderkey = c.o_orderkey) group by change
""")
def q_upsert_summary(spark, sf):
    return upsert.change_summary(current_snapshot(spark, sf), incoming(spark, sf), ["o_orderkey"])


# ---------------------------------------------------------------------------
# JOIN-3 / JOIN-4 / RPT-10: customers first seen on or after a cut-off
# ---------------------------------------------------------------------------
CUTOFF = "1996-01-01"


def new_customers(spark, sf):
    """Orders of keys not seen before ``CUTOFF``, rolled up per key: a key is
    new if its first order is not before the cut-off, so one scan and one
    aggregate take the place of a self anti join.  Orders without a date count
    for nothing, as neither side of that join has them."""
    o = T(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    per_key = o.filter(F.col("o_orderdate").isNotNull() & F.col("o_custkey").isNotNull()).groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_seen"), F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.bround(F.col("o_totalprice") * 100).cast("bigint")).alias("spent_cents"))
    return per_key.filter(F.col("first_seen") >= F.lit(CUTOFF).cast("timestamp_ntz"))


_SQL_NEW = f"""nk as (select o_custkey, min(o_orderdate) as first_seen, count(*) as n_orders,
    cast(sum(cast(round_even(o_totalprice * 100, 0) as bigint)) as bigint) as spent_cents
  from orders o where o_orderdate >= timestamp '{CUTOFF}'
    and not exists (select 1 from orders k where k.o_custkey = o.o_custkey and k.o_orderdate < timestamp '{CUTOFF}')
  group by o_custkey)"""


@register("new_keys", f"with {_SQL_NEW} select o_custkey, cast(cast(first_seen as date) as varchar) as first_seen, "
                      "n_orders, spent_cents from nk")
def q_new_keys(spark, sf):
    return dates_as_text(new_customers(spark, sf).withColumn("first_seen", F.to_date("first_seen")))


MAX_SHOWN = 5


@register("new_key_report", f"""with {_SQL_NEW},
n as (select count(*) as total from nk),
top as (select *, row_number() over (order by first_seen desc, o_custkey) as rank from nk
        order by first_seen desc, o_custkey limit {MAX_SHOWN}),
a as (select top.*, (select total from n) as total, date_diff('day', cast(first_seen as date), date '{AS_OF}') as d
      from top)
select cast(rank as bigint) as rank, o_custkey,
  'Detected ' || cast(total as varchar) || ' new keys!' ||
    case when total > {MAX_SHOWN} then ' (only showing first {MAX_SHOWN} of ' || cast(total as varchar) || ')' else '' end
    as headline,
  'New key (#' || cast(rank as varchar) || '/' || cast(total as varchar) || '): ' || cast(o_custkey as varchar) || chr(10)
  || '    - Tracked since ' || case when d is null then 'unknown' when d < 0 then 'in the future' when d = 0 then 'today'
       when d = 1 then 'yesterday' when d < 30 then cast(d as varchar) || ' days ago'
       when d < 60 then 'a month ago' when d < 365 then cast(cast(floor(d / 30) as bigint) as varchar) || ' months ago'
       when d < 730 then 'a year ago' else cast(cast(floor(d / 365) as bigint) as varchar) || ' years ago' end || '.' || chr(10)
  || '    - orders: ' || format('{{:,}}', n_orders) || chr(10)
  || '    - total spent: ' || format('{{:,.2f}}', spent_cents / 100.0) as message
from a
""")
def q_new_key_report(spark, sf):
    nk = new_customers(spark, sf)
    total = nk.select(F.count(F.lit(1))).scalar()  # scalar subquery, evaluated once
    top = nk.orderBy(F.desc("first_seen"), F.asc("o_custkey")).limit(MAX_SHOWN)
    from pyspark.sql import Window
    # the window runs over the <= MAX_SHOWN rows left after the limit
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("first_seen"), F.asc("o_custkey")))
                         .cast("bigint")).withColumn("total", total)
    headline = F.concat(F.lit("Detected "), F.col("total").cast("string"), F.lit(" new keys!"),
                        F.when(F.col("total") > MAX_SHOWN,
                               F.concat(F.lit(f" (only showing first {MAX_SHOWN} of "), F.col("total").cast("string"),
                                        F.lit(")"))).otherwise(F.lit("")))
    message = F.concat(
        F.lit("New key (#"), F.col("rank").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit("): "),
        F.col("o_custkey").cast("string"), F.lit("\n    - Tracked since "),
        D.humanised_age("first_seen", AS_OF), F.lit(".\n    - orders: "), F.format_number("n_orders", 0),
        F.lit("\n    - total spent: "), F.format_number(F.col("spent_cents") / 100.0, 2))
    return top.select("rank", "o_custkey", headline.alias("headline"), message.alias("message"))
