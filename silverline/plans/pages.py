"""Page queries over ``pages(page_id, url, html)`` (EXT-*, FLT-9..13,
STR-7..19)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from silverline.functions import predicates as P
from silverline.functions import strings as S
from silverline.operators import extract as X
from silverline.operators import extractors, seen
from silverline.plans.registry import T, register
from silverline.session import stored
from silverline.streaming.jobs import work_dir

TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"


@register("page_titles", f"""
with t as (select page_id, nullif(trim(regexp_replace(regexp_extract(html, '{TITLE_RE}', 1), '\\s+', ' ', 'g')), '')
  as title from pages),
d as (select page_id, replace(replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') as title from t)
select page_id, title, split_part(title, ' (', 1) as entity_name from d
""")
def q_page_titles(spark, sf):
    p = T(spark, sf, "pages")
    return p.select("page_id", X.page_title("html").alias("title"), X.entity_name_from_title("html").alias("entity_name"))


# The test pages write every anchor as <a href="...">: the oracle cuts the page
# at that text, without a pattern.  Links with an apostrophe, a character
# reference and single quotes are added to each page on both sides.
def _with_odd_links(pages):
    k = F.col("page_id").cast("string")
    odd = F.concat(F.lit("<a class=x href='/odd?a="), k, F.lit("&amp;b=o%27brien.'>odd</a><a href=\"/o'brien/"), k, F.lit('">o</a>'))
    return pages.withColumn("html", F.concat("html", odd))


_SQL_LINKS = """l as (select page_id, url, list_concat(
  list_transform(string_split(html, '<a href="')[2:], lambda x: split_part(x, '"', 1)),
  ['/odd?a=' || page_id || '&b=o%27brien', '/o''brien/' || page_id]) as hs from pages)"""


@register("page_links", f"""
with {_SQL_LINKS}
select page_id, cast(i - 1 as integer) as link_idx, rtrim(hs[i], '.') as href from l, range(1, len(hs) + 1) r(i)
""")
def q_page_links(spark, sf):
    return X.links(_with_odd_links(T(spark, sf, "pages")), keep=["page_id"])


_SLUG_SQL = ("nullif(regexp_extract(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), "
             "'([^/]+)/?$', 1), '')")


@register("page_sizes", f"""
select page_id, cast(strlen(html) as bigint) as n_bytes, {_SLUG_SQL} as slug, strlen(html) >= 5000 as is_big from pages
""")
def q_page_sizes(spark, sf):
    p = T(spark, sf, "pages")
    return p.select("page_id", X.page_size("html").cast("bigint").alias("n_bytes"), X.url_slug("url").alias("slug"),
                    P.min_bytes("html", 5000).alias("is_big"))


# A direct article URL on the test hosts: one language folder, one page
# segment, an optional final slash; no query.
ARTICLE_URL = r"^https://[a-z.]+\.example\.(com|net|org)/[a-z]{2}/[^/?=#]+/?$"


@register("url_predicate", f"""
select page_id, url,
  (not regexp_matches(url, '/amp/?$') and regexp_matches(url, '{ARTICLE_URL}')
   and not regexp_matches(url, '[\\r\\n]')) as is_direct,
  (contains(html, '<article>') or contains(html, 'class="ad"')) as has_marker,
  strlen(html) >= 5000 as is_big,
  coalesce(cast(nullif(regexp_extract(url, 'page=(\\d+)', 1), '') as integer), 1) > 1
    and page_id % 3 = 0 as is_last_page
from pages
""")
def q_url_predicate(spark, sf):
    """A pager that says "last page" is added to every third page."""
    p = T(spark, sf, "pages").withColumn("pager", F.when(F.col("page_id") % 3 == 0, '<li class="page-item disabled">').otherwise("<li>"))
    page_no = F.coalesce(S.extract_group("url", r"page=(\d+)").cast("int"), F.lit(1))
    return p.select("page_id", "url", P.is_direct_url("url", ARTICLE_URL).alias("is_direct"),
                    P.has_any_marker("html", ["<article>", 'class="ad"']).alias("has_marker"),
                    P.min_bytes("html", 5000).alias("is_big"),
                    P.is_last_page(F.concat("html", "pager"), page_no).alias("is_last_page"))


@register("url_parts", f"""
with u as (select page_id, url,
  nullif(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '') as host,
  nullif(regexp_extract(url, '://[^/]+/([a-z]{{2}})/', 1), '') as lang from pages)
select page_id, host, lang,
  string_split(url, '/')[-1] as last_part,
  replace(url, '.html', '') as no_suffix,
  regexp_replace(regexp_replace('https://mirror.example.org/' || '/' || host || '/' || lang, '/{{2,}}', '/', 'g'),
                 '^([A-Za-z][A-Za-z0-9+.-]*):/', '\\1://') as mirror_url,
  replace(lang || ' ' || string_split(url, '/')[-1], ' ', '-') as slug,
  split_part(url, '?', 1) as before_query,
  regexp_replace(url, '[/]+$', '') as no_trailing_slash,
  'url:' || url as prefixed,
  {_SLUG_SQL} as url_slug
from u
""")
def q_url_parts(spark, sf):
    p = T(spark, sf, "pages")
    host = S.extract_group("url", r"^[a-z]+://([^/?#]+)")
    lang = S.extract_group("url", r"://[^/]+/([a-z]{2})/")
    u = p.select("page_id", "url", host.alias("host"), lang.alias("lang"))
    return u.select("page_id", "host", "lang", S.split_last("url", "/").alias("last_part"),
                    S.replace_literal("url", ".html", "").alias("no_suffix"),
                    S.join_url(F.lit("https://mirror.example.org/"), F.col("host"), F.col("lang")).alias("mirror_url"),
                    S.slugify(S.concat_sep(" ", "lang", S.split_last("url", "/"))).alias("slug"),
                    S.text_before("url", "?").alias("before_query"),
                    S.rstrip_chars("url", "/").alias("no_trailing_slash"),
                    S.concat_strict(F.lit("url:"), F.col("url")).alias("prefixed"),
                    X.url_slug("url").alias("url_slug"))


def _absolute_links(spark, sf):
    p = T(spark, sf, "pages")
    l = X.links(_with_odd_links(p.select("page_id", "url", "html")), keep=["url"])
    origin = F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1)
    return l.select(F.when(F.col("href").startswith("/"), F.concat(origin, F.col("href")))
                    .otherwise(F.col("href")).alias("href"))


_SQL_ABS = f"""{_SQL_LINKS},
found as (select case when starts_with(h, '/') then regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || h else h end
    as href from (select url, rtrim(unnest(hs), '.') as h from l))"""


@register("frontier_round", f"""with {_SQL_ABS}
select distinct href as url from found f where not exists (select 1 from pages p where p.url = f.href)
""")
def q_frontier_round(spark, sf):
    return X.frontier_round(_absolute_links(spark, sf), T(spark, sf, "pages").select("url"))


@register("frontier_counts", f"""with {_SQL_ABS},
u as (select href as url, 1 as f, 0 as s from found union all select url, 0, 1 from pages),
per as (select url, max(f) as f, max(s) as s from u group by url)
select count(*) as total_count, cast(sum(s) as bigint) as completed_count,
  count(*) filter (where f = 1 and s = 0) as remaining_count from per
""")
def q_frontier_counts(spark, sf):
    return X.frontier_counts(_absolute_links(spark, sf), T(spark, sf, "pages").select("url"))


@register("frontier_seen", f"""with {_SQL_ABS},
fresh as (select distinct href as url from found f where not exists (select 1 from pages p where p.url = f.href))
select 1 as round, url from fresh union all select 2, url || '#2' from fresh
""")
def q_frontier_seen(spark, sf):
    """EXT-8 over a stored set: page URLs come in by two calls, what a round
    finds is added, and the next round finds only what it has not seen."""
    root, pages = f"{work_dir(spark, 'seen')}/set", T(spark, sf, "pages").select("page_id", "url")
    half = F.pmod("page_id", F.lit(2)) == 0
    seen.add(spark, root, pages.filter(half), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    seen.add(spark, root, pages.filter(~half))
    found = _absolute_links(spark, sf).select("href")
    first = stored(seen.frontier_round(spark, root, found), "first-round")
    seen.add(spark, root, first)
    again = first.select(F.concat("url", F.lit("#2")).alias("href"))
    second = seen.frontier_round(spark, root, found.unionByName(again))
    return first.select(F.lit(1).alias("round"), "url").unionByName(second.select(F.lit(2).alias("round"), "url"))


@register("page_list_items", r"""
with m as (select page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1) as items from pages)
select page_id, cast(i - 1 as integer) as item_idx,
  trim(regexp_replace(regexp_replace(items[i], '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) as item_text,
  case when regexp_matches(items[i], '(?i)<a\b[^>]*\bhref') then
    regexp_extract(items[i], '(?i)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"', 1) end as item_href
from m, range(1, len(items) + 1) r(i)
""")
def q_page_list_items(spark, sf):
    """EXT-4 style ``<li>`` extraction over the stored pages."""
    return X.html_list_items(T(spark, sf, "pages"), ["page_id"])


# The stored pages hold no tables, grids, label cells or pagers.  The queries
# below write such pages from table rows and read them back; their oracles
# take the values from those rows.
def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


#: Orders on one page.
PAGE_ORDERS = 500


def _customer_orders(spark, sf):
    """Runs of up to ``PAGE_ORDERS`` orders of a customer in the order of their
    keys, with the rank of the first: (o_custkey, first, orders).  Orders are
    ranked inside sorted ranges, and a customer may span many of them."""
    o = T(spark, sf, "orders").select("o_custkey", F.struct(
        "o_orderkey", F.col("o_totalprice").cast("long").alias("total"), F.col("o_orderstatus").alias("status"),
        F.substring("o_orderpriority", 1, 1).alias("rank")).alias("o"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(o.repartitionByRange(parts, "o_custkey", "o.o_orderkey").withColumn("_range", F.spark_partition_id()), "customer-orders")
    sizes = ranged.groupBy("o_custkey", "_range").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("o_custkey", "_custkey").withColumnRenamed("_range", "_part")
    # one row per customer and range
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("_custkey").orderBy("_part")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("o_custkey", "_range").orderBy("o.o_orderkey")) - 1
    runs = (ranged.withColumn("_inside", inside).groupBy("o_custkey", "_range", F.floor(F.col("_inside") / PAGE_ORDERS).alias("_run"))
            .agg(F.array_sort(F.collect_list("o")).alias("orders")))
    same = F.col("o_custkey").eqNullSafe(F.col("_custkey")) & (F.col("_range") == F.col("_part"))
    return runs.join(before, same).select("o_custkey", (F.col("_before") + F.col("_run") * PAGE_ORDERS).alias("first"), "orders")


def _row_idx():
    """Place of a row among all of its customer's."""
    return (F.col("first") + F.col("row_idx")).cast("int").alias("row_idx")


_SQL_CUSTOMER_ORDERS = """lines as (select o_custkey as page_id, o_orderkey, cast(trunc(o_totalprice) as bigint) as total, o_orderstatus as status,
  substr(o_orderpriority, 1, 1) as rank, cast(row_number() over (partition by o_custkey order by o_orderkey) - 1 as integer) as row_idx from orders)"""


@register("page_tables", f"""
with {_SQL_CUSTOMER_ORDERS}
select page_id, row_idx, 'Order & ' || o_orderkey as order_name, '/order?id=' || o_orderkey || '&v=''1''' as order_href,
  cast(total as varchar) as total, status || rank as extra
from lines
""")
def q_page_tables(spark, sf):
    """EXT-1: one page per customer and run of orders; cells and rows without end tags, a linked
    cell in each row, one cell more than headers."""
    def row(x, i):
        return _text("<tr class='r'><td><a href=\"/order?id=", x["o_orderkey"], "&amp;v='1'\">Order &amp; ", x["o_orderkey"], "</a><td>", x["total"],
                     F.when(i % 2 == 0, "</td><td>").otherwise("<td>"), x["status"], "<i> </i>", x["rank"])
    pages = _customer_orders(spark, sf).select(F.col("o_custkey").alias("page_id"), "first", _text(
        "<table><tr><td>not this one</table><table class=\"wide table\"><thead><tr><th>Order<th> Total </thead>",
        F.array_join(F.transform("orders", row), "\n"), "</table><table class='table'><tr><td>nor this</td></tr></table>").alias("html"))
    cells = F.col("cells")
    return X.html_tables(pages, ["page_id", "first"]).select(
        "page_id", _row_idx(), cells["Order"].alias("order_name"), cells["Order_href"].alias("order_href"), cells["Total"].alias("total"), cells["_col2"].alias("extra"))


@register("page_grids", f"""
with {_SQL_CUSTOMER_ORDERS}
select page_id, row_idx, cast(o_orderkey as varchar) as order_name, status || ', ' || rank as flags, cast(total as varchar) as total_2,
  case when total % 3 > 0 then 'https://example.org/order/' || o_orderkey else '' end as url from lines
""")
def q_page_grids(spark, sf):
    """EXT-2: one grid of nested divs per customer and run of orders, with tags, a repeated header and a link on some rows."""
    def row(x):
        link = F.when(x["total"] % 3 > 0, _text("<a href='/order/", x["o_orderkey"], "'>", x["o_orderkey"], "</a>")).otherwise(x["o_orderkey"].cast("string"))
        return _text("<div class=\"tr odd\"><div class='td'>", link, "</div><div class=\"td\"><div class=\"tag\">", x["status"],
                     "</div><a class='blue tag' href='/x'>", x["rank"], "</a></div><div class='td'>1</div><div class='td'>", x["total"], "</div></div>")
    pages = _customer_orders(spark, sf).select(F.col("o_custkey").alias("page_id"), "first", _text(
        "<div><div class='box_table'><div class='tr'><div class='th'>Order</div><div class='th'>Flags</div><div class='th'>Total</div><div class='th'>Total</div></div>",
        F.array_join(F.transform("orders", row), ""), "</div><div class='tr'><div class='td'>outside</div></div></div>").alias("html"))
    cells = F.col("cells")
    return X.html_grid(pages, ["page_id", "first"], link_col="Order", base_url="https://example.org/").select(
        "page_id", _row_idx(), cells["Order"].alias("order_name"), cells["Flags"].alias("flags"), cells["Total_2"].alias("total_2"), cells["url"].alias("url"))


@register("page_label_values", """
select o_orderkey as page_id, o_orderpriority as priority, o_orderstatus || ' & more' as status,
  case when o_custkey % 2 = 0 then cast(o_custkey as varchar) end as customer, 2 + (o_custkey + 1) % 2 as n_pairs from orders
""")
def q_page_label_values(spark, sf):
    """EXT-3: label and value cells written from each order, with a header row, stray text and a key given twice."""
    o = T(spark, sf, "orders")
    customer = F.when(F.col("o_custkey") % 2 == 0, _text("<tr><td class='coin_type label customer'>Customer<td class=\"value big\">", F.col("o_custkey"))).otherwise("")
    html = _text("<table><tr><th>Field</th><th>Value</th></tr><tr><td class='label status'>Status</td><td class='value'>old</td></tr>stray",
                 "<tr><td class=\"label coin_type priority\">Priority</td> <td class='value'> <b>", F.col("o_orderpriority"), "</b> </td></tr>", customer,
                 "<tr><td class='label status'>Status</td><td class='value'>", F.col("o_orderstatus"), " &amp; more</td></tr></table>")
    kv = F.col("kv")
    return X.html_label_values(o.select(F.col("o_orderkey").alias("page_id"), html.alias("html")), ["page_id"]).select(
        "page_id", kv["priority"].alias("priority"), kv["status"].alias("status"), kv["customer"].alias("customer"), F.size("kv").cast("bigint").alias("n_pairs"))


@register("page_info_pairs", """
select c_custkey as page_id, case when c_custkey % 11 <> 0 then c_name end as name,
  case when c_custkey % 11 = 0 or c_custkey % 13 = 0 or c_custkey % 17 = 0 then null else c_mktsegment || ', Nation ' || c_nationkey end as links,
  cast(case when c_custkey % 11 = 0 then 0 when c_custkey % 13 = 0 or c_custkey % 17 = 0 then 1 else 2 end as bigint) as n_pairs,
  case when c_custkey % 11 = 0 then 'missing section' when c_custkey % 13 = 0 then 'repeated key Name'
       when c_custkey % 17 = 0 then 'missing value' end as error
from customer
""")
def q_page_info_pairs(spark, sf):
    """EXT-4: key and value items written from each customer: hidden items,
    links, items without end tags, and the errors that a contract would judge."""
    c = T(spark, sf, "customer")
    key = F.col("c_custkey")
    odd = (F.when(key % 13 == 0, "<li><span class='info'>Name</span><span class='value'>again</span></li>")
           .when(key % 17 == 0, "<li><span class=\"info\">Balance</span></li>").otherwise(""))
    items = _text("<li class='x hidden'><span class='info'>Name</span><span class='value'>hidden</span></li><li><span class='info'>Name</span> <span class='value big'>\n",
                  F.col("c_name"), " </span>", odd, "<li><span class='info'>Links</span><a href='/s'>", F.col("c_mktsegment"),
                  "</a>, <a href='/n'>Nation\n ", F.col("c_nationkey"), "</a><a href='/e'> </a></ul>")
    html = F.when(key % 11 == 0, "<section id='other'></section>").otherwise(
        _text("<section><li>no</section><section class=s id=\"technical-details\"><section>inner</section><ul>", items, "</section><li>no"))
    kv = F.col("kv")
    out = X.html_info_pairs(c.select(key.alias("page_id"), html.alias("html")), ["page_id"], section_attr=("id", "technical-details"))
    return out.select("page_id", kv["Name"].alias("name"), kv["Links"].alias("links"), F.size("kv").cast("bigint").alias("n_pairs"), "error")


@register("next_page_links", """
select o_orderkey as page_id, ['/list?page=' || o_custkey || '&s=''1''', '/b'] as hrefs from orders
""")
def q_next_page_links(spark, sf):
    """EXT-7: a pager written from each order, with markup inside the anchors."""
    html = _text("<a href='/p'>Previous 1</a><a class=n href=\"/list?page=", F.col("o_custkey"),
                 "&amp;s='1'\"><b>\n Next</b> 3</a> Next 9 <a href='/b'>Next 4</a><a href='/c'>Next page</a>")
    return X.pagination_links(T(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html")), ["page_id"])


def _scripts(spark, sf):
    """A script payload of several fragments around each event's properties."""
    ev = T(spark, sf, "events")
    inner = F.replace("props", F.lit('"'), F.lit('\\"'))
    noise = _text('{"early": 1} START {bad: 1} {"n": NaN} ', F.when(F.col("event_id") % 3 == 0, '{"event": ').otherwise('['))
    parts = F.array(F.replace(noise, F.lit('"'), F.lit('\\"')), inner, F.when(F.col("event_id") % 3 == 0, "}").otherwise("]"),
                    F.lit(' {\\"a\\":\\"<\\/b> }\\"} {'))
    return ev.select("event_id", X.script_payload(parts, "START").alias("text"))


@register("embedded_json", """
select event_id, cast(0 as integer) as obj_idx, case when event_id % 3 = 0 then '{"event": ' || props || '}' else props end as json from events
union all select event_id, 1, '{"a":"</b> }"}' from events
""")
def q_embedded_json(spark, sf):
    """EXT-9: objects in a joined, unescaped and cut payload, among text that only looks like JSON."""
    return X.embedded_json(_scripts(spark, sf), ["event_id"])


@register("embedded_first", """
select event_id, cast(0 as integer) as obj_idx, props as json from events where event_id % 3 <> 0 and json_extract(props, '$.k') is not null
""")
def q_embedded_first(spark, sf):
    """EXT-10: of each payload the first object with the key ``k``."""
    return X.first_with_keys(q_embedded_json(spark, sf), ["event_id"], ["k"], "k string")


@register("objects_by_sql", """
select event_id, cast(0 as integer) as obj_idx, case when event_id % 3 = 0 then '{"event": ' || props || '}' else props end as json from events
union all select event_id, 1, '{"a":"</b> }"}' from events
""")
def q_objects_by_sql(spark, sf):
    """UDF-3: the objects of EXT-9 by a table function inside SQL text."""
    extractors.register_extractors(spark)
    return spark.sql("select s.event_id, o.obj_idx, o.json from {scripts} s, lateral json_objects(s.text) o", scripts=_scripts(spark, sf))
