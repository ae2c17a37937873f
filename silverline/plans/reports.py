"""Named reports built from the operators (RPT-1, RPT-2, RPT-7, RPT-8,
RPT-9) and plain SQL over registered views (SRC-3)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from silverline.functions import dates as D
from silverline.functions import numbers as N
from silverline.operators import dedup, entity, extract as X
from silverline.operators.contract import FAILURES, Contract
from silverline.operators.stack import SourceSpec, stack
from silverline.plans import entities as EN
from silverline.plans.registry import AS_OF, T, dates_as_text, register
from silverline.session import stored
from silverline.sources.tables import register_views

# ---------------------------------------------------------------------------
# RPT-1: silver parties = stack -> canonical names (ENT-2) -> contract split
# ---------------------------------------------------------------------------
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SILVER_CONTRACT = Contract(
    name="silver_parties",
    schema=StructType([
        StructField("source_site", StringType(), False),
        StructField("entity_source_id", StringType(), False),
        StructField("entity_name", StringType(), False),
        StructField("group_name", StringType(), False),
        StructField("segment", StringType(), True),
        StructField("balance_cents", LongType(), True),
    ]),
    primary_key=["source_site", "entity_source_id"],
    min_length={"entity_name": 2, "group_name": 4},
    max_length={"entity_name": 200, "group_name": 100},
    enums={"segment": SEGMENTS},
    non_negative=["balance_cents"],
)


@register("silver_parties", f"""
with s as {EN._SQL_STACK},
k as (select *, regexp_replace(lower(reported_group_name), '[^A-Za-z0-9]', '', 'g') as nk from s),
c as (select nk, min(reported_group_name) as canon from k where nk is not null and nk <> '' group by nk),
g as (select k.*, case when canon is null or canon = '' then reported_group_name else canon end as group_name
      from k left join c using (nk)),
f as (select *, list_filter([
  case when entity_name is null then 'entity_name|nullability' end,
  case when length(entity_name) < 2 then 'entity_name|min_length' end,
  case when length(entity_name) > 200 then 'entity_name|max_length' end,
  case when group_name is null then 'group_name|nullability' end,
  case when length(group_name) < 4 then 'group_name|min_length' end,
  case when length(group_name) > 100 then 'group_name|max_length' end,
  case when segment is not null and segment not in ({', '.join(f"'{x}'" for x in SEGMENTS)}) then 'segment|enum' end,
  case when balance_cents < 0 then 'balance_cents|min' end,
  case when count(*) over (partition by source_site, entity_source_id) > 1 then 'primary_key' end
  ], lambda x: x is not null) as fl from g)
select source_site, entity_source_id, entity_name, group_name, segment, balance_cents,
  array_to_string(list_sort(fl), ';') as failures, len(fl) = 0 as passed
from f
""")
def q_silver_parties(spark, sf):
    st = entity.canonical_names(EN.stacked_parties(spark, sf), "reported_group_name", "group_name")
    checked = SILVER_CONTRACT.check(st)
    return checked.select(*SILVER_CONTRACT.columns, F.array_join(F.array_sort(FAILURES), ";").alias("failures"),
                          (F.size(FAILURES) == 0).alias("passed"))


# ---------------------------------------------------------------------------
# RPT-2: silver devices = unit conversion + keep-best dedup + union + ENT-1
# ---------------------------------------------------------------------------
DEVICE_SCHEMA = StructType([
    StructField("source_site", StringType(), False),
    StructField("source_table", StringType(), False),
    StructField("miner_type", StringType(), False),
    StructField("miner_name", StringType(), False),
    StructField("reported_algo_name", StringType(), False),
    StructField("hashrate_hashes_per_second", LongType(), True),
    StructField("price_usd", DoubleType(), True),
    StructField("power_watts", DoubleType(), True),
])
_UNITS = list(N.HASHRATE_UNITS)
_NSP = len(EN.SPELLINGS)


def _spelling(idx):
    return F.element_at(F.array(*[F.lit(s) for s in EN.SPELLINGS]), (idx % _NSP + 1).cast("int"))


def q_silver_devices(spark, sf):
    p = T(spark, sf, "part")
    unit = F.element_at(F.array(*[F.lit(u) for u in _UNITS]), (F.col("p_partkey") % len(_UNITS) + 1).cast("int"))
    catalog = p.select(F.lit("catalog").alias("source_site"), F.lit("part").alias("source_table"),
                       F.lit("ASIC").alias("miner_type"), F.col("p_name").alias("miner_name"),
                       _spelling(F.col("p_partkey")).alias("reported_algo_name"),
                       N.to_per_second("p_retailprice", unit).alias("hashrate_hashes_per_second"),
                       F.col("p_retailprice").alias("price_usd"), (F.col("p_size") * 10.0).alias("power_watts"))
    # several hash rates per device: keep the largest (WIN-1), before the union
    catalog = dedup.keep_last(catalog, ["miner_name", "reported_algo_name"], ["hashrate_hashes_per_second"])
    promo = p.filter(F.col("p_type") == "PROMO")
    parts = [
        SourceSpec(catalog, mapping={c: c for c in catalog.columns}),
        SourceSpec(promo, tags={"source_site": "promo", "source_table": "part", "miner_type": "GPU"}, mapping={
            "miner_name": F.concat("p_name", F.lit(" GPU")),
            "reported_algo_name": _spelling(F.col("p_partkey") + 7),
            "hashrate_hashes_per_second": N.round_to_int(F.col("p_size") * 1e6),
            "power_watts": F.col("p_size").cast("double"),
        }),
    ]
    s = stack(parts, DEVICE_SCHEMA)
    return s.withColumn("algo_name", entity.normalize_names(F.col("reported_algo_name")))


_SQL_SP = EN._sql_spelling_array()
_SQL_UNIT_ARR = "[" + ", ".join(f"'{u}'" for u in _UNITS) + "]"
_SQL_FACTOR = "case unit " + " ".join(f"when '{u}' then {f!r}" for u, f in N.HASHRATE_UNITS.items()) + " end"
_CAT_REST = ["source_site", "source_table", "miner_type", "hashrate_hashes_per_second", "price_usd", "power_watts"]

register("silver_devices", f"""
with u as (select *, {_SQL_UNIT_ARR}[p_partkey % {len(_UNITS)} + 1] as unit from part),
cat0 as (select 'catalog' as source_site, 'part' as source_table, 'ASIC' as miner_type, p_name as miner_name,
   {_SQL_SP}[p_partkey % {_NSP} + 1] as reported_algo_name,
   cast(round_even(p_retailprice * {_SQL_FACTOR}, 0) as bigint) as hashrate_hashes_per_second,
   p_retailprice as price_usd, p_size * 10.0 as power_watts from u),
cat as (select * from cat0 qualify row_number() over (partition by miner_name, reported_algo_name
   order by hashrate_hashes_per_second desc nulls last, {', '.join(c + ' desc nulls last' for c in _CAT_REST)}) = 1),
promo as (select 'promo' as source_site, 'part' as source_table, 'GPU' as miner_type, p_name || ' GPU' as miner_name,
   {_SQL_SP}[(p_partkey + 7) % {_NSP} + 1] as reported_algo_name,
   cast(round_even(p_size * 1e6, 0) as bigint) as hashrate_hashes_per_second,
   cast(null as double) as price_usd, cast(p_size as double) as power_watts from part where p_type = 'PROMO'),
s as (select * from cat union all select * from promo)
select *, {EN._sql_normalize('reported_algo_name')} as algo_name from s
""")(q_silver_devices)


# ---------------------------------------------------------------------------
# RPT-7: device x dimension from nested lists (embeddings): stack two tagged
# lists, explode, round, keep the best vector per (type, label, dim)
# ---------------------------------------------------------------------------
@register("miner_algorithms", """
with e as (select vec_id, label, case when label % 2 = 0 then 'ASIC' else 'GPU' end as miner_type, embedding
           from embeddings),
x as (select vec_id, label, miner_type, cast(i - 1 as integer) as dim, embedding[i] as v
      from e, range(1, len(embedding) + 1) r(i)),
m as (select miner_type, label, dim, vec_id, cast(round_even(cast(v as double) * 1000, 0) as bigint) as milli from x)
select miner_type, label, dim, vec_id, milli from m
qualify row_number() over (partition by miner_type, label, dim order by milli desc nulls last, vec_id desc nulls last) = 1
""")
def q_miner_algorithms(spark, sf):
    from silverline.operators.stack import union_tagged
    e = T(spark, sf, "embeddings")
    even = F.coalesce(F.col("label") % 2 == 0, F.lit(False))  # odd, negative odd and NULL labels are the other list
    lists = union_tagged({"ASIC": e.filter(even), "GPU": e.filter(~even)}, "miner_type")
    x = lists.select("vec_id", "label", "miner_type", F.posexplode_outer("embedding").alias("dim", "v"))
    m = x.select("miner_type", "label", "dim", "vec_id",
                 N.round_to_int(F.col("v").cast("double") * 1000).alias("milli"))
    best = dedup.keep_last(m, ["miner_type", "label", "dim"], ["milli", "vec_id"])
    return best.select("miner_type", "label", "dim", "vec_id", "milli")


# ---------------------------------------------------------------------------
# RPT-8: typed ingestion of API-style records (explicit schema, JSON with NULLs)
# ---------------------------------------------------------------------------
PROPS_SCHEMA = "k BIGINT"


@register("typed_events", """
with e as (select *, cast(json_extract(props, '$.k') as bigint) as k from events)
select event_id, user_id, event_type, value, k,
  to_json([{'k': k, 'half': case when k % 2 = 0 then k // 2 end}])::varchar as props_json,
  row_number() over (order by value desc nulls last, event_id) as place
from e
""")
def q_typed_events(spark, sf):
    ev = T(spark, sf, "events")
    k = F.from_json("props", PROPS_SCHEMA)["k"]
    typed = ev.select("event_id", "user_id", "event_type", "value", k.alias("k"))
    half = F.when(F.col("k") % 2 == 0, (F.col("k") / 2).cast("bigint"))
    out = typed.withColumn("props_json", F.to_json(F.array(F.struct(F.col("k").alias("k"), half.alias("half"))),
                                                   {"ignoreNullFields": "false"}))
    return _placed(out, [F.desc_nulls_last("value"), F.asc("event_id")])  # SRT-1


# ---------------------------------------------------------------------------
# RPT-9: typed page records (slug, name, size, earliest year, sorted)
# ---------------------------------------------------------------------------
@register("page_records", f"""
with p as (select page_id, url, html,
  {'nullif(regexp_extract(regexp_extract(url, ' + "'^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]+)/?$', 1), '')"} as slug,
  split_part(replace(replace(replace(replace(nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), ''),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), ' (', 1) as entity_name,
  cast(strlen(html) as bigint) as n_bytes,
  case when page_id % 4 = 0 then null when page_id % 40 <= {AS_OF[2:4]} then least(2000 + page_id % 40, 2019) else 2019 end as earliest_year,
  case when page_id % 14 between 1 and 12 and 2010 + page_id % 20 <= {AS_OF[:4]}
       then make_date(cast(2010 + page_id % 20 as integer), cast(page_id % 14 as integer), 1) end as logo_date
  from pages)
select page_id, slug, entity_name, n_bytes, cast(earliest_year as bigint) as earliest_year,
  cast(least(earliest_year, 2000 + cast(page_id % 30 as integer)) as bigint) as first_year,
  cast(case when page_id % 5 <> 0 then least(logo_date, date '2021-05-01') end as varchar) as earliest_logo_date,
  row_number() over (order by n_bytes desc nulls last, page_id) as place
from p
""")
def q_page_records(spark, sf):
    """Year mentions and a logo container with nested elements are added to
    the stored pages from their ids; the place is the rank in the sort order."""
    p = T(spark, sf, "pages")
    k = F.col("page_id")

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    def asset(year, month):
        return F.concat(F.lit("<img src='/wp-content/uploads/"), year, F.lit("/"), month, F.lit("/a_b-logo.png'>"))

    years = F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("<p>Founded In 20"), two(k % 40), F.lit(", listed in 2019, gone in 1999</p>")))
    logo = F.when(k % 5 == 0, "").otherwise(F.concat(
        F.lit('<div class="x name-logo"><div><div>deep</div>'), asset((2010 + k % 20).cast("string"), two(k % 14)), F.lit("</div>"),
        asset(F.lit("2021"), F.lit("05")), F.lit("</div>")))
    page = F.concat("html", years, logo, asset(F.lit("2001"), F.lit("01")))  # the last one lies outside the container
    ey = D.earliest_year_mention(page, AS_OF)
    out = p.select("page_id", X.url_slug("url").alias("slug"), X.entity_name_from_title("html").alias("entity_name"),
                   X.page_size("html").cast("bigint").alias("n_bytes"), ey.cast("bigint").alias("earliest_year"),
                   N.least_non_null(ey, (F.lit(2000) + (F.col("page_id") % 30)).cast("int")).cast("bigint")
                   .alias("first_year"),
                   D.earliest_upload_date(D.logo_scope(page), AS_OF).alias("earliest_logo_date"))
    return dates_as_text(_placed(out, [F.desc_nulls_last("n_bytes"), F.asc("page_id")]))


def _placed(df, order):
    """Rows with their place in a global order: sorted ranges, the rows of the
    ranges before, and the place inside the range, so no task holds all rows."""
    from pyspark.sql import Window

    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = stored(df.repartitionByRange(int(parts), *order).withColumn("_range", F.spark_partition_id()), "ordered")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(before, "_range").withColumn("place", (F.col("_before") + inside).cast("long")).drop("_range", "_before")


# ---------------------------------------------------------------------------
# SRC-2 / SRC-3: SQL text over registered views
# ---------------------------------------------------------------------------
_VIEW_SQL = """select lang, count(*) as n_docs, cast(sum(n_chars) as bigint) as total_chars,
  count(distinct source) as n_sources from documents group by lang"""

register("sql_over_views", _VIEW_SQL)(
    lambda spark, sf: (register_views(spark, sf, ("documents",)), spark.sql(_VIEW_SQL))[1])
