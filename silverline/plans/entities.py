"""Entity queries: normalisation, stacking, dedup and the gold rollups
(ENT-1..3, SET-1..3, WIN-1/2, AGG-*, RPT-3..6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverline.functions import strings as S
from silverline.functions import numbers as N
from silverline.operators import dedup, entity, rollup
from silverline.operators.stack import SourceSpec, stack
from silverline.plans.registry import T, dates_as_text, register

# ---------------------------------------------------------------------------
# ENT-1: reported algorithm spellings derived from `part`, then normalised by
# the rewrite rules + alias table preset.  The spelling of each part is picked
# from the list below by p_partkey, with the part size appended to a few
# families so every rule sees many distinct inputs.
# ---------------------------------------------------------------------------
SPELLINGS = [
    "cryptonight heavy", "CryptoNight_Lite", "Cryptonight", "cryptonight-", "CRYPTONIGHT V7",
    "equihash 144_5", "Equihash(192,7)", "EQUIHASH 96 5", "equihash 210,9",
    "cuckatoo31", "Cuckatoo32", "CUCKATOO", "sha 256", "SHA 2 family", "sha3",
    "Blake2b SHA3", "blake2b sha3", "BMW 512", "Nexa Pow", "NexaPow", "Kaw Pow", "Qubit",
    "Yescript", "X11 Gost", "Verus hash", "Lyra2z", "Scrypt", "Ethash", "",
]


def _reported_algo(partkey):
    arr = F.array(*[F.lit(s) for s in SPELLINGS])
    base = F.element_at(arr, (partkey % len(SPELLINGS) + 1).cast("int"))
    return base


def _sql_spelling_array() -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in SPELLINGS) + "]"


def _sql_normalize(expr: str) -> str:
    """The same rewrite chain in DuckDB SQL (first match: no 'g' flag)."""
    e = f"regexp_replace({expr}, '(?i)cryptonight[-_ ]?', 'CryptoNight-')"
    e = f"(case when {e} = 'CryptoNight-' then 'CryptoNight' else {e} end)"
    e = f"regexp_replace({e}, '(?i)equihash(?:[(, ]*)(\\d+)[,_ ](\\d+)(?:[), ]*)', 'Equihash(\\1,\\2)')"
    e = f"regexp_replace({e}, '(?i)\\b(cuckatoo)', 'Cuckatoo', 'g')"
    e = f"regexp_replace({e}, '(?i)\\b(SHA 2)', 'SHA-2', 'g')"
    e = f"regexp_replace({e}, '(?i)\\b(sha3)', 'SHA3', 'g')"
    mapping = entity.alias_mapping(entity.ALGORITHM_ALIASES)
    whens = " ".join("when '" + k.replace("'", "''") + "' then '" + v.replace("'", "''") + "'"
                     for k, v in mapping.items())
    return f"(case {e} {whens} else {e} end)"


def q_alias_normalize(spark, sf):
    p = T(spark, sf, "part")
    brand_rules = (entity.Rewrite(r"(?i)brand#", "Brand-", first_only=True),)
    reported = F.when((F.col("p_partkey") % 3) == 0,
                      F.concat(_reported_algo(F.col("p_partkey")), F.lit(" "), F.col("p_size").cast("string"))
                      ).otherwise(_reported_algo(F.col("p_partkey")))
    return (p.select("p_partkey", reported.alias("reported_algo_name"), "p_brand")
            .select("p_partkey", "reported_algo_name",
                    entity.normalize_names(F.col("reported_algo_name")).alias("algo_name"),
                    entity.normalize_names(F.col("p_brand"), rules=brand_rules, aliases={}).alias("brand_name")))


_SQL_REPORTED = (f"case when p_partkey % 3 = 0 then {_sql_spelling_array()}[p_partkey % {len(SPELLINGS)} + 1]"
                 f" || ' ' || cast(p_size as varchar) else {_sql_spelling_array()}[p_partkey % {len(SPELLINGS)} + 1] end")

register("alias_normalize", f"""
select p_partkey, reported_algo_name, {_sql_normalize('reported_algo_name')} as algo_name,
       regexp_replace(p_brand, '(?i)brand#', 'Brand-') as brand_name
from (select p_partkey, p_brand, {_SQL_REPORTED} as reported_algo_name from part)
""")(q_alias_normalize)


# ---------------------------------------------------------------------------
# ENT-2 / ENT-3: spelling variants of part names (upper, dashes, no blank, as is)
# ---------------------------------------------------------------------------
def _name_variants(spark, sf):
    p = T(spark, sf, "part")
    v = (F.when(F.col("p_partkey") % 4 == 0, F.upper("p_name"))
         .when(F.col("p_partkey") % 4 == 1, F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
         .when(F.col("p_partkey") % 4 == 2, F.replace(F.col("p_name"), F.lit(" "), F.lit("")))
         .otherwise(F.col("p_name")))
    return p.select("p_partkey", v.alias("reported_name"))


_SQL_VARIANTS = """(select p_partkey, case p_partkey % 4 when 0 then upper(p_name)
  when 1 then replace(p_name, ' ', '-') when 2 then replace(p_name, ' ', '') else p_name end as reported_name
  from part)"""


@register("canonical_names", f"""
with v as {_SQL_VARIANTS},
k as (select *, regexp_replace(lower(reported_name), '[^A-Za-z0-9]', '', 'g') as nk from v),
c as (select nk, min(reported_name) as canon from k where nk is not null and nk <> '' group by nk)
select p_partkey, reported_name,
       case when canon is null or canon = '' then reported_name else canon end as canonical_name
from k left join c using (nk)
""")
def q_canonical_names(spark, sf):
    return entity.canonical_names(_name_variants(spark, sf), "reported_name", "canonical_name")


@register("alias_opportunities", f"""
with v as {_SQL_VARIANTS}
select regexp_replace(lower(reported_name), '[^A-Za-z0-9]', '', 'g') as name_key,
       to_json(list_sort(list(distinct reported_name)))::varchar as names_json,
       count(distinct reported_name) as n_names
from v where reported_name is not null
group by 1 having count(distinct reported_name) > 1
""")
def q_alias_opportunities(spark, sf):
    return entity.alias_opportunities(_name_variants(spark, sf), "reported_name")


# ---------------------------------------------------------------------------
# SET-1: stack customers and suppliers into one party schema
# ---------------------------------------------------------------------------
PARTY_SCHEMA = StructType([
    StructField("source_site", StringType(), False),
    StructField("source_table", StringType(), False),
    StructField("entity_source_id", StringType(), False),
    StructField("reported_entity_name", StringType(), True),
    StructField("entity_name", StringType(), True),
    StructField("reported_group_name", StringType(), True),
    StructField("entity_url", StringType(), True),
    StructField("entity_code", StringType(), True),
    StructField("segment", StringType(), True),
    StructField("balance_cents", LongType(), True),
])


def _group_spelling(key, name):
    """Three spellings of one nation name, picked by the party key."""
    lower_blank = F.lower(F.replace(name, F.lit("_"), F.lit(" ")))
    cap_dash = F.concat(F.upper(F.substring(name, 1, 1)),
                        F.lower(F.replace(F.substr(name, F.lit(2)), F.lit("_"), F.lit("-"))))
    return F.when(key % 3 == 0, name).when(key % 3 == 1, lower_blank).otherwise(cap_dash)


_SQL_GROUP_SPELLING = """case {k} % 3 when 0 then n_name when 1 then lower(replace(n_name, '_', ' '))
  else upper(substr(n_name, 1, 1)) || lower(replace(substr(n_name, 2), '_', '-')) end"""


def stacked_parties(spark, sf):
    nation = T(spark, sf, "nation").select("n_nationkey", "n_name")
    cust = T(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    supp = T(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    parts = [
        SourceSpec(cust, tags={"source_site": "customer", "source_table": "customer"}, mapping={
            "entity_source_id": F.col("c_custkey"),
            "reported_entity_name": F.col("c_name"),
            "entity_name": S.clean_text("c_name"),
            "reported_group_name": _group_spelling(F.col("c_custkey"), F.col("n_name")),
            "entity_url": S.template("https://example.org/customer/{}/", "c_custkey"),
            "entity_code": S.concat_sep("-", F.lit("customer"), F.col("c_mktsegment")),
            "segment": F.col("c_mktsegment"),
            "balance_cents": N.round_to_int(F.col("c_acctbal") * 100),
        }),
        SourceSpec(supp, tags={"source_site": "supplier", "source_table": "supplier"}, mapping={
            "entity_source_id": F.col("s_suppkey"),
            "reported_entity_name": F.col("s_name"),
            "entity_name": S.clean_text("s_name"),
            "reported_group_name": _group_spelling(F.col("s_suppkey"), F.col("n_name")),
            "entity_url": S.template("https://example.org/supplier/{}/", "s_suppkey"),
            "entity_code": S.concat_sep("-", F.lit("supplier"), F.lit(None).cast("string")),
            "balance_cents": N.round_to_int(F.col("s_acctbal") * 100),
        }),
    ]
    return stack(parts, PARTY_SCHEMA)


_SQL_STACK = f"""(
select 'customer' as source_site, 'customer' as source_table, cast(c_custkey as varchar) as entity_source_id,
  c_name as reported_entity_name, nullif(trim(regexp_replace(c_name, '\\s+', ' ', 'g')), '') as entity_name,
  {_SQL_GROUP_SPELLING.format(k='c_custkey')} as reported_group_name,
  'https://example.org/customer/' || cast(c_custkey as varchar) || '/' as entity_url,
  'customer' || '-' || c_mktsegment as entity_code, c_mktsegment as segment,
  cast(round_even(c_acctbal * 100, 0) as bigint) as balance_cents
from customer join nation on c_nationkey = n_nationkey
union all
select 'supplier', 'supplier', cast(s_suppkey as varchar), s_name,
  nullif(trim(regexp_replace(s_name, '\\s+', ' ', 'g')), ''),
  {_SQL_GROUP_SPELLING.format(k='s_suppkey')},
  'https://example.org/supplier/' || cast(s_suppkey as varchar) || '/',
  'supplier' || '-' || cast(null as varchar), cast(null as varchar),
  cast(round_even(s_acctbal * 100, 0) as bigint)
from supplier join nation on s_nationkey = n_nationkey)"""

register("stack_parties", f"select * from {_SQL_STACK}")(stacked_parties)


@register("stack_tagged_events", """
select 'events' as source, event_id as record_id, ts as record_ts, value as amount from events
union all
select 'orders', o_orderkey, o_orderdate, o_totalprice from orders
""", ts=("record_ts",))
def q_stack_tagged_events(spark, sf):
    from silverline.operators.stack import union_tagged
    ev = T(spark, sf, "events").select(F.col("event_id").alias("record_id"), F.col("ts").alias("record_ts"),
                                       F.col("value").alias("amount"))
    od = T(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"),
                                       F.col("o_orderdate").alias("record_ts"),
                                       F.col("o_totalprice").alias("amount"))
    return union_tagged({"events": ev, "orders": od}, "source").select("source", "record_id", "record_ts", "amount")


# ---------------------------------------------------------------------------
# WIN-1 / WIN-2 / AGG-13
# ---------------------------------------------------------------------------
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_REST = [c for c in _LI_COLS if c not in ("l_partkey", "l_suppkey")]

register("dedup_keep_best", f"""
select {', '.join(_LI_COLS)} from lineitem
qualify row_number() over (partition by l_partkey, l_suppkey
  order by l_quantity desc nulls last, l_shipdate desc nulls last, l_extendedprice desc nulls last,
  {', '.join(c + ' desc nulls last' for c in _LI_REST)}) = 1
""", ts=("l_shipdate",))(lambda spark, sf: dedup.keep_last(T(spark, sf, "lineitem").select(*_LI_COLS),
                                       ["l_partkey", "l_suppkey"],
                                       # SRT-4: multi-key order with an expression
                                       ["l_quantity", "l_shipdate", F.col("l_extendedprice").cast("double")])
     .select(*_LI_COLS))


@register("dedup_keep_first", """
select user_id, event_id, ts, event_type, value from events
qualify row_number() over (partition by user_id order by ts nulls first, event_id nulls first,
  event_type nulls first, value nulls first, props nulls first) = 1
""", ts=("ts",))
def q_dedup_keep_first(spark, sf):
    ev = T(spark, sf, "events")
    return dedup.keep_first(ev, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "ts",
                                                                       "event_type", "value")


register("distinct_sorted", """
select distinct l_returnflag, l_linestatus from lineitem order by all
""")(lambda spark, sf: dedup.distinct_sorted(T(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"]))


# ---------------------------------------------------------------------------
# RPT-3 / RPT-4 / RPT-5: gold rollups per nation
# ---------------------------------------------------------------------------
def parties_with_activity(spark, sf, kept=None):
    """Stacked parties with a canonical group name (ENT-2, mapping built from
    every stacked spelling, as the reference builds its map from the whole
    silver table) and ``created_at`` = the party's first activity: first
    order (customers), first shipment (suppliers).  Both activity tables
    are partial+final aggregates joined on the party key.  ``kept`` (rows with
    the party key, such as a published silver table) limits the parties."""
    st = entity.canonical_names(stacked_parties(spark, sf), "reported_group_name", "group_name")
    if kept is not None:
        st = st.join(kept.select("source_site", "entity_source_id"), ["source_site", "entity_source_id"], "left_semi")
    first_order = (T(spark, sf, "orders").groupBy("o_custkey")
                   .agg(F.min("o_orderdate").alias("created_at"))
                   .select(F.lit("customer").alias("source_site"),
                           F.col("o_custkey").cast("string").alias("entity_source_id"), "created_at"))
    first_ship = (T(spark, sf, "lineitem").groupBy("l_suppkey")
                  .agg(F.min("l_shipdate").alias("created_at"))
                  .select(F.lit("supplier").alias("source_site"),
                          F.col("l_suppkey").cast("string").alias("entity_source_id"), "created_at"))
    # a party without activity stays: it counts as a member and has no first or last date
    return st.join(first_order.unionByName(first_ship), ["source_site", "entity_source_id"], "left")


_SQL_ACTIVE = f"""keyed as (select *, regexp_replace(lower(reported_group_name), '[^A-Za-z0-9]', '', 'g') as nk
  from {_SQL_STACK}),
canon as (select nk, min(reported_group_name) as canon from keyed where nk is not null and nk <> '' group by nk),
named as (select keyed.*, case when canon is null or canon = '' then reported_group_name else canon end as group_name
          from keyed left join canon using (nk)),
active as (select s.*, a.created_at from named s left join (
    select 'customer' as source_site, cast(o_custkey as varchar) as entity_source_id, min(o_orderdate) as created_at
    from orders group by o_custkey
    union all
    select 'supplier', cast(l_suppkey as varchar), min(l_shipdate) from lineitem group by l_suppkey
  ) a using (source_site, entity_source_id))"""

_SQL_GOLD_ENT = """select group_name,
  to_json(list_sort(list(distinct source_site)))::varchar as source_sites_json,
  to_json(list_sort(list(distinct source_table)))::varchar as source_tables_json,
  count(distinct entity_name) as entity_count,
  min(created_at) as earliest_created_at, max(created_at) as latest_created_at,
  arg_min(entity_name || ' @ ' || source_site, {'t': created_at, 'l': entity_name || ' @ ' || source_site})
    filter (created_at is not null) as earliest_entity,
  arg_max(entity_name || ' @ ' || source_site, {'t': created_at, 'l': entity_name || ' @ ' || source_site})
    filter (created_at is not null) as latest_entity,
  coalesce(sum(balance_cents), 0) / 100.0 as balance_total,
  list_sort(list(distinct reported_group_name)) as aliases,
  to_json(list_sort(list_distinct(list(segment))))::varchar as segments_json
from active where group_name is not null group by group_name"""


def gold_entities(spark, sf, kept=None):
    act = parties_with_activity(spark, sf, kept)
    g = rollup.entity_rollup(act, "group_name", "entity_name", "source_site", "source_table", "created_at",
                             "reported_group_name", sums={"_balance_cents": "balance_cents"},
                             lists={"segments_json": "segment"})
    return g.withColumn("balance_total", F.col("_balance_cents") / F.lit(100.0)).drop("_balance_cents")


@register("gold_rollup", f"""
with {_SQL_ACTIVE}, g as ({_SQL_GOLD_ENT})
select * exclude (aliases), to_json(aliases)::varchar as reported_aliases_json from g
""", ts=("earliest_created_at", "latest_created_at"))
def q_gold_rollup(spark, sf):
    g = gold_entities(spark, sf)
    return g.withColumn("reported_aliases_json", F.to_json("_reported_aliases")).drop("_reported_aliases")


def gold_devices(spark, sf):
    """Device side: returned line items ('R') per supplier nation."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    sup = T(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = T(spark, sf, "nation").select("n_nationkey", "n_name")
    j = (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .select("l_partkey", "l_returnflag", "l_shipdate",
                 F.col("n_name").alias("group_name"),
                 _group_spelling(F.col("l_orderkey"), F.col("n_name")).alias("reported_group_name")))
    return rollup.device_rollup(j, "group_name", "l_partkey", "l_returnflag", "R",
                                {"earliest_device_date": ("min", "l_shipdate"),
                                 "latest_device_date": ("max", "l_shipdate")},
                                "reported_group_name")


_SQL_GOLD_DEV = f"""select n_name as group_name, count(distinct l_partkey) as device_count,
  min(l_shipdate) as earliest_device_date, max(l_shipdate) as latest_device_date,
  list_sort(list(distinct {_SQL_GROUP_SPELLING.format(k='l_orderkey')})) as aliases_dev
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
where l_returnflag = 'R' and n_name is not null group by n_name"""


@register("gold_device_rollup", f"""
select * exclude (aliases_dev), to_json(aliases_dev)::varchar as reported_aliases_json from ({_SQL_GOLD_DEV})
""", ts=("earliest_device_date", "latest_device_date"))
def q_gold_device_rollup(spark, sf):
    d = gold_devices(spark, sf)
    return d.withColumn("reported_aliases_json", F.to_json("_reported_aliases_dev")).drop("_reported_aliases_dev")


@register("gold_join", f"""
with {_SQL_ACTIVE}, g as ({_SQL_GOLD_ENT}), d as ({_SQL_GOLD_DEV})
select g.group_name, source_sites_json, source_tables_json, entity_count,
  cast(cast(earliest_created_at as date) as varchar) as earliest_created_at,
  cast(cast(latest_created_at as date) as varchar) as latest_created_at,
  earliest_entity, latest_entity, balance_total, segments_json, device_count,
  cast(cast(earliest_device_date as date) as varchar) as earliest_device_date,
  cast(cast(latest_device_date as date) as varchar) as latest_device_date,
  to_json(list_sort(list_distinct(list_concat(coalesce(aliases, []), coalesce(aliases_dev, [])))))::varchar
    as reported_aliases_json
from g left join d on g.group_name = d.group_name
""")
def q_gold_join(spark, sf):
    return dates_as_text(rollup.gold_join(gold_entities(spark, sf), gold_devices(spark, sf), "group_name"))


# ---------------------------------------------------------------------------
# RPT-6: summary by brand (junk groups last, truncated member list)
# ---------------------------------------------------------------------------
@register("summary_by_group", """
with p as (select case when p_partkey % 50 = 0 then null else p_brand end as p_brand, p_name, p_retailprice,
                  cast(round_even(p_retailprice * 100, 0) as bigint) as cents, p_size from part),
g as (select p_brand, coalesce(sum(cents), 0) / 100.0 as value_total, count(*) as member_count,
             min(p_size) as earliest_year,
             list(p_name order by p_retailprice desc nulls last, p_name asc nulls last) as members
      from p group by p_brand)
select p_brand, value_total, member_count,
  round_even(value_total / member_count, 0) as value_per_member, earliest_year,
  case when p_brand is null or p_brand in ('Brand#13', 'Brand#7') then 0.0 else value_total end as sort_order,
  case when p_brand is null or p_brand in ('Brand#13', 'Brand#7') then 0.0
       else round_even(value_total / member_count, 0) end as sort_order_per_member,
  case when len(members) > 14 then 'TRUNCATED' || chr(10) || array_to_string(members[1:15], chr(10)) || chr(10) || '...'
       else array_to_string(members, chr(10)) end as member_list,
  to_json(members[1:200])::varchar as member_list_json
from g
""")
def q_summary_by_group(spark, sf):
    p = T(spark, sf, "part").select(
        F.when(F.col("p_partkey") % 50 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"),
        "p_name", "p_retailprice", N.round_to_int(F.col("p_retailprice") * 100).alias("cents"), "p_size")
    return rollup.summary_by_group(p, "p_brand", "p_name", "p_retailprice", "cents", "p_size",
                                   junk=["Brand#13", "Brand#7"], value_divisor=100.0)


# ---------------------------------------------------------------------------
# AGG-9 / SRT-5 / AGG-10
# ---------------------------------------------------------------------------
register("value_counts", """
select event_type, count(*) as count from events group by event_type
""")(lambda spark, sf: rollup.value_counts(T(spark, sf, "events"), "event_type"))

register("top_k", """
select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders
order by o_totalprice desc nulls last, o_orderkey limit 10
""", ts=("o_orderdate",))(lambda spark, sf: rollup.top_k(T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                                  "o_orderdate"),
                                   10, [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")]))


@register("total_value", """
select cast(sum(cast(round_even(o_totalprice * 100, 0) as bigint)) as bigint) as total_cents,
       cast(sum(cast(round_even(o_totalprice * 100, 0) as bigint)) as bigint) / 100.0 as total_value,
       count(*) as n_orders
from orders
""")
def q_total_value(spark, sf):
    o = T(spark, sf, "orders")
    cents = N.round_to_int(F.col("o_totalprice") * 100)
    return o.agg(F.sum(cents).alias("total_cents"), F.count(F.lit(1)).alias("n_orders")).select(
        "total_cents", (F.col("total_cents") / F.lit(100.0)).alias("total_value"), "n_orders")
