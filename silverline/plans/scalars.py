"""Scalar-expression queries: cleaning, sentinels, numbers, dates, lists,
JSON, predicates (STR-*, MTH-*, DAT-*, ARR-*, JSN-*, FLT-*, PRJ-11/12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.functions import arrays as A
from silverline.functions import dates as D
from silverline.functions import numbers as N
from silverline.functions import predicates as P
from silverline.functions import strings as S
from silverline.plans.registry import AS_OF, T, dates_as_text, register


@register("clean_strings", r"""
select doc_id,
  nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '') as text_clean,
  nullif(trim(regexp_replace(lang, '\s+', ' ', 'g')), '') as lang_clean,
  nullif(trim(regexp_replace(source, '\s+', ' ', 'g')), '') as source_clean,
  cast(length(nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '')) as bigint) as n_chars_clean
from documents
""")
def q_clean_strings(spark, sf):
    from silverline.operators.clean import clean_strings
    d = clean_strings(T(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    return d.select("doc_id", F.col("text").alias("text_clean"), F.col("lang").alias("lang_clean"),
                    F.col("source").alias("source_clean"),
                    F.char_length("text").cast("bigint").alias("n_chars_clean"))


@register("sentinel_to_null", """
select o_orderkey,
  case when o_orderstatus in ('P') then null else o_orderstatus end as order_status,
  case when o_orderpriority in ('4-NOT SPECIFIED', 'None', 'N/A') then null else o_orderpriority end as order_priority
from orders
""")
def q_sentinel_to_null(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", S.sentinel_to_null("o_orderstatus", ["P"]).alias("order_status"),
                    S.sentinel_to_null("o_orderpriority", ["4-NOT SPECIFIED", "None", "N/A"]).alias("order_priority"))


_UNITS = list(N.HASHRATE_UNITS) + ["XH/s"]
_SQL_UNITS = "[" + ", ".join(f"'{u}'" for u in _UNITS) + "]"
_SQL_FACTOR = "case unit " + " ".join(f"when '{u}' then {f!r}" for u, f in N.HASHRATE_UNITS.items()) + " end"


@register("unit_convert", f"""
with u as (select p_partkey, p_retailprice,
  case when p_partkey % 17 = 0 then null else {_SQL_UNITS}[p_partkey % {len(_UNITS)} + 1] end as unit from part)
select p_partkey, unit, cast(round_even(p_retailprice * {_SQL_FACTOR}, 0) as bigint) as hashrate_per_second,
  (unit is null or unit in ({', '.join(f"'{u}'" for u in N.HASHRATE_UNITS)})) as unit_known
from u
""")
def q_unit_convert(spark, sf):
    p = T(spark, sf, "part")
    unit = F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).otherwise(
        F.element_at(F.array(*[F.lit(u) for u in _UNITS]), (F.col("p_partkey") % len(_UNITS) + 1).cast("int")))
    u = p.select("p_partkey", "p_retailprice", unit.alias("unit"))
    return u.select("p_partkey", "unit", N.to_per_second("p_retailprice", "unit").alias("hashrate_per_second"),
                    N.unit_is_known("unit").alias("unit_known"))


@register("currency_parse", r"""
with t as (select o_orderkey, case when o_orderkey % 13 = 0 then 'n/a'
  else '$' || regexp_replace(cast(o_totalprice as varchar), '(\d)(\d{3})\.', '\1,\2.')
       || case when o_orderkey % 2 = 0 then ' USD' else '' end end as price_text from orders)
select o_orderkey, price_text,
  cast(round_even(try_cast(trim(replace(replace(replace(replace(price_text, '$', ''), ',', ''), ' USD', ''), 'USD', ''))
       as double), 0) as bigint) as price_int
from t
""")
def q_currency_parse(spark, sf):
    o = T(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 13 == 0, F.lit("n/a")).otherwise(F.concat(
        F.lit("$"), F.regexp_replace(F.col("o_totalprice").cast("string"), r"(\d)(\d{3})\.", "$1,$2."),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit(" USD")).otherwise(F.lit(""))))
    t = o.select("o_orderkey", text.alias("price_text"))
    return t.select("o_orderkey", "price_text", N.currency_to_int("price_text").alias("price_int"))


_SUFFIXES = ["k", "K", "M", "B", "T", ""]


@register("magnitude_parse", f"""
with t as (select c_custkey, case when c_custkey % 7 = 0 then '$1,234'
  else '$' || cast(c_acctbal as varchar) || {"[" + ", ".join(f"'{x}'" for x in _SUFFIXES) + "]"}[c_custkey % 6 + 1] end
  as amount_text from customer),
s as (select *, trim(replace(amount_text, '$', '')) as s from t)
select c_custkey, amount_text,
  try_cast(trim(regexp_replace(s, '[kKMBT]$', '')) as double) *
  coalesce(case regexp_extract(s, '([kKMBT])$', 1) when 'k' then 1000.0 when 'K' then 1000.0
           when 'M' then 1000000.0 when 'B' then 1000000000.0 when 'T' then 1000000000000.0 end, 1.0) as amount
from s
""")
def q_magnitude_parse(spark, sf):
    c = T(spark, sf, "customer")
    sfx = F.element_at(F.array(*[F.lit(x) for x in _SUFFIXES]), (F.col("c_custkey") % 6 + 1).cast("int"))
    text = F.when(F.col("c_custkey") % 7 == 0, F.lit("$1,234")).otherwise(
        F.concat(F.lit("$"), F.col("c_acctbal").cast("string"), sfx))
    t = c.select("c_custkey", text.alias("amount_text"))
    return t.select("c_custkey", "amount_text", N.magnitude_to_number("amount_text").alias("amount"))


@register("round_vs_trunc", """
with n as (select l_orderkey, l_linenumber, l_quantity, l_extendedprice * (1 - l_discount) as net from lineitem)
select l_orderkey, l_linenumber,
  cast(round_even(net, 0) as bigint) as net_rounded, cast(trunc(net) as bigint) as net_truncated,
  round_even(net, 8) as net_8,
  cast(round_even(l_quantity / 2, 0) as bigint) as half_qty_even, cast(round(l_quantity / 2) as bigint) as half_qty_up
from n
""")
def q_round_vs_trunc(spark, sf):
    li = T(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", N.round_to_int(net).alias("net_rounded"),
                     N.truncate_to_int(net).alias("net_truncated"), N.round_half_even(net, 8).alias("net_8"),
                     N.round_to_int(F.col("l_quantity") / 2).alias("half_qty_even"),
                     F.round(F.col("l_quantity") / 2).try_cast("bigint").alias("half_qty_up"))


@register("date_parts", """
with d as (select o_orderkey, cast(o_orderdate as date) as order_date,
  case when o_orderkey % 7 = 0 then null else cast(o_orderdate as date) end as maybe_date from orders)
select o_orderkey, cast(order_date as varchar) as order_date, cast(year(order_date) as bigint) as order_year,
  cast(make_date(cast(year(order_date) as integer), 1, 1) as varchar) as year_start,
  cast(coalesce(maybe_date, make_date(cast(year(order_date) as integer), 1, 1)) as varchar) as first_known,
  cast(least(maybe_date, date '1997-01-01') as varchar) as earliest
from d
""")
def q_date_parts(spark, sf):
    o = T(spark, sf, "orders")
    d = o.select("o_orderkey", D.iso_to_date("o_orderdate").alias("order_date"))
    d = d.withColumn("maybe_date", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("order_date")))
    out = d.select("o_orderkey", "order_date", D.year_of("order_date").cast("bigint").alias("order_year"),
                   D.year_start(D.year_of("order_date")).alias("year_start"),
                   D.first_non_null("maybe_date", D.year_start(D.year_of("order_date"))).alias("first_known"),
                   N.least_non_null("maybe_date", F.lit("1997-01-01").cast("date")).alias("earliest"))
    return dates_as_text(out)


@register("date_parse", """
with t as (select o_orderkey, case when o_orderkey % 11 = 0 then 'n/a' else strftime(o_orderdate, '%b %d, %Y') end
  as date_text from orders)
select o_orderkey, date_text, cast(cast(try_strptime(date_text, '%b %d, %Y') as date) as varchar) as parsed_date from t
""")
def q_date_parse(spark, sf):
    o = T(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 11 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "MMM dd, yyyy"))
    t = o.select("o_orderkey", text.alias("date_text"))
    return dates_as_text(t.select("o_orderkey", "date_text", D.parse_date("date_text", "MMM d, yyyy").alias("parsed_date")))


@register("year_mentions", f"""
with t as (select o_orderkey, 'founded in ' || cast(year(o_orderdate) + 10 as varchar) || '; moved IN '
  || cast(year(o_orderdate) + 5 as varchar) || ', see in ' || cast(1990 + o_orderkey % 40 as varchar) as mention_text
  from orders)
select o_orderkey, mention_text,
  cast(list_min(list_filter(list_transform(regexp_extract_all(mention_text, '(?i)in (20\\d{{2}})', 1), lambda x: cast(x as integer)),
       lambda y: y >= 2000 and y <= {AS_OF[:4]})) as bigint) as earliest_year
from t
""")
def q_year_mentions(spark, sf):
    o = T(spark, sf, "orders")
    text = F.concat(F.lit("founded in "), (F.year("o_orderdate") + 10).cast("string"), F.lit("; moved IN "),
                    (F.year("o_orderdate") + 5).cast("string"), F.lit(", see in "),
                    (F.lit(1990) + F.col("o_orderkey") % 40).cast("string"))
    t = o.select("o_orderkey", text.alias("mention_text"))
    return t.select("o_orderkey", "mention_text",
                    D.earliest_year_mention("mention_text", AS_OF).cast("bigint").alias("earliest_year"))


@register("json_lists", """
with g as (select o_custkey, count(*) as n_orders,
  list_sort(list_distinct(list(o_orderpriority))) as priorities,
  list_sort(list_distinct(list(case when o_orderstatus = 'P' then null else o_orderstatus end))) as statuses,
  list_sort(list_distinct(list({'p': o_orderpriority,
     'label': case when o_orderpriority = '5-LOW' then null else upper(substr(o_orderpriority, 3)) end}))) as labelled
  from orders group by o_custkey),
h as (select *, case when n_orders > 10 then statuses end as statuses_or_null from g)
select o_custkey, n_orders, to_json(priorities)::varchar as priorities_json,
  to_json(statuses_or_null)::varchar as statuses_json,
  to_json(list_sort(list_distinct(list_concat(coalesce(priorities, []), coalesce(statuses_or_null, [])))))::varchar
    as merged_json,
  cast(len(list_distinct(list_concat(coalesce(priorities, []), coalesce(statuses_or_null, [])))) as bigint) as n_merged,
  json_array_length(to_json(statuses_or_null)) > 0 as statuses_not_empty,
  to_json(labelled)::varchar as labelled_json
from h
""")
def q_json_lists(spark, sf):
    from silverline.operators.rollup import sorted_set
    o = T(spark, sf, "orders")
    label = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.upper(F.substr("o_orderpriority", F.lit(3))))
    g = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), sorted_set("o_orderpriority").alias("priorities"),
        sorted_set(F.nullif("o_orderstatus", F.lit("P"))).alias("statuses"),
        sorted_set(F.struct(F.col("o_orderpriority").alias("p"), label.alias("label"))).alias("labelled"))
    h = g.withColumn("statuses_or_null", F.when(F.col("n_orders") > 10, F.col("statuses")))
    merged = A.merge_sorted("priorities", "statuses_or_null")
    return h.select("o_custkey", "n_orders", A.to_json_list("priorities").alias("priorities_json"),
                    A.to_json_list("statuses_or_null").alias("statuses_json"),
                    A.to_json_list(merged).alias("merged_json"), F.size(merged).cast("bigint").alias("n_merged"),
                    A.json_array_not_empty(A.to_json_list("statuses_or_null")).alias("statuses_not_empty"),
                    A.to_json_list("labelled").alias("labelled_json"))


@register("explode_outer_props", """
with e as (select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events),
l as (select event_id, k, case when event_type = 'view' then null
   when event_type = 'click' then []::STRUCT(k BIGINT, t VARCHAR)[]
   else list_transform(range(k % 3), lambda i: {'k': k, 't': event_type}) end as items from e)
select event_id, k, it.k as item_k, it.t as item_type from (
  select event_id, k, unnest(case when items is null or len(items) = 0 then [NULL::STRUCT(k BIGINT, t VARCHAR)]
                                   else items end) as it from l)
""")
def q_explode_outer_props(spark, sf):
    ev = T(spark, sf, "events")
    parsed = ev.select("event_id", "event_type", F.from_json("props", "k BIGINT").alias("p"))
    k = F.col("p.k")  # PRJ-11: struct field access
    item = F.struct(k.alias("k"), F.col("event_type").alias("t"))
    items = (F.when(F.col("event_type") == "view", F.lit(None))
             .when(F.col("event_type") == "click", F.array().cast("array<struct<k:bigint,t:string>>"))
             .otherwise(F.array_repeat(item, (k % 3).cast("int"))))
    l = parsed.select("event_id", k.alias("k"), items.alias("items"))
    # PRJ-12: explode_outer keeps a row (with NULL item) for a NULL or empty list
    x = l.select("event_id", "k", F.explode_outer("items").alias("it"))
    return x.select("event_id", "k", F.col("it.k").alias("item_k"), F.col("it.t").alias("item_type"))


@register("flags_and_case", """
with p as (select *, case when p_partkey % 9 = 0 then null else p_type end as maybe_type from part)
select p_partkey, maybe_type,
  coalesce(contains(p_name, 'ring'), false) as is_ring,
  p_type = 'PROMO' as is_promo,
  (maybe_type is null or coalesce(maybe_type in ('PROMO', 'None'), false)) as is_junk,
  case when p_size < 10 then 'S' when p_size < 30 then 'M' else 'L' end as size_class,
  maybe_type is not distinct from p_type as same_type,
  maybe_type is not null as has_type
from p
""")
def q_flags_and_case(spark, sf):
    p = T(spark, sf, "part").withColumn(
        "maybe_type", F.when(F.col("p_partkey") % 9 == 0, F.lit(None)).otherwise(F.col("p_type")))
    out = p.select("p_partkey", "maybe_type",
                   P.contains_flag("p_name", "ring").alias("is_ring"),
                   (F.col("p_type") == "PROMO").alias("is_promo"),
                   P.is_null_or_in("maybe_type", ["PROMO", "None", None]).alias("is_junk"),
                   F.when(F.col("p_size") < 10, "S").when(F.col("p_size") < 30, "M").otherwise("L").alias("size_class"),
                   P.eq_null_safe("maybe_type", "p_type").alias("same_type"),
                   F.col("maybe_type").isNotNull().alias("has_type"))
    # SRT-1 (desc, NULLs last) then SRT-2 (desc with NULLs first, the other engine's default)
    return out.orderBy(F.desc_nulls_last("maybe_type"), F.desc_nulls_first("p_partkey"))


_AGE_AS_OF = "1998-08-02"


@register("humanised_age", f"""
with d as (select o_orderkey, case when o_orderkey % 13 = 0 then null else cast(o_orderdate as date) end as order_date
  from orders),
a as (select *, date_diff('day', order_date, date '{_AGE_AS_OF}') as n from d)
select o_orderkey, cast(order_date as varchar) as order_date,
  case when n is null then 'unknown' when n < 0 then 'in the future' when n = 0 then 'today'
       when n = 1 then 'yesterday' when n < 30 then cast(n as varchar) || ' days ago'
       when n < 60 then 'a month ago' when n < 365 then cast(cast(floor(n / 30) as bigint) as varchar) || ' months ago'
       when n < 730 then 'a year ago' else cast(cast(floor(n / 365) as bigint) as varchar) || ' years ago' end as age
from a
""")
def q_humanised_age(spark, sf):
    o = T(spark, sf, "orders")
    d = o.select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, F.lit(None))
                 .otherwise(F.to_date("o_orderdate")).alias("order_date"))
    return dates_as_text(d.select("o_orderkey", "order_date", D.humanised_age("order_date", _AGE_AS_OF).alias("age")))
