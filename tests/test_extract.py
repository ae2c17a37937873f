"""EXT-1..12 on fixtures written for these tests."""

import json
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.functions import dates as D
from silverline.functions import predicates as P
from silverline.operators import extract as X

SHELF = """<div class='room'><section id="shelf" class="main"><ul>
<li><span class="info">Room</span> <span class="value">North
   wing</span>
<li class="hidden"><span class="info">Room</span><span class="value">Cellar</span>
<li><span class='info'>Subjects</span><a href="/s/1">Maps</a>, <a href="/s/2">Sea &amp; sky</a><a href="/s/3"> </a></li>
<li><span class="info">Volumes</span><span class="value">1,204</span></li>
</ul></section></div>"""

PARTS = """<p>intro</p><div class="frame box_table wide"><div class="tr head"><div class="th">Part</div><div class="th">Makers</div>
<div class="th">Part</div></div>
<div class="tr"><div class="td"><a href="//parts/bolt">Bolt <b>M4</b></a></div><div class="td"><div class="tag">Ames</div><a class="tag x" href="/m">Bell</a></div><div class="td">9</div></div>
<div class="tr"><div class="td">Nut</div><div class="td"></div></div></div><div class="tr"><div class="td">outside</div></div>"""

BOOKS = """<table class="plain"><tr><td>other</table><table class='table wide'><tr><th>Title<th>Year
<tr><td><a href='/book?id=1&amp;lang=en'>On "Stars"</a><td>1911<td>signed
<tr><td>The O&#39;Neil <i>letters</i><td></table>"""

FACTS = """<table><tr><th>Fact</th><th>Value</th></tr><tr><td class="label area">Area</td><td class="value"> 12 <b>ha</b></td></tr>
loose text<tr><td class='label coin_type height'>Height</td><td class='value'>3 m</td></tr>
<tr><td class="label area">Area</td><td class="value">14 ha</td></tr><tr><td class="label">none</td><td class="value">x</td></tr></table>"""


def one(spark, html, fn, **kw):
    df = spark.createDataFrame([(1, html)], "id long, html string")
    return sorted((r.asDict() for r in fn(df, ["id"], **kw).collect()), key=lambda r: r.get("row_idx", r.get("item_idx")) or 0)


def test_tables(spark):
    rows = [r["cells"] for r in one(spark, BOOKS, X.html_tables)]
    assert rows == [{"Title": 'On "Stars"', "Title_href": "/book?id=1&lang=en", "Year": "1911", "_col2": "signed"},
                    {"Title": "The O'Neilletters", "Year": ""}]
    assert one(spark, BOOKS, X.html_tables, link_mode="first")[0]["cells"]["link_href"] == "/book?id=1&lang=en"
    assert one(spark, "<p>none</p>", X.html_tables) == [] and one(spark, None, X.html_tables) == []
    assert one(spark, "<table class='table'><tr><th>A<th>A<tr><td>1<td>2", X.html_tables)[0]["cells"] == {"A": "2"}


def test_grid(spark):
    rows = [r["cells"] for r in one(spark, PARTS, X.html_grid, link_col="Part", base_url="https://parts.example")]
    assert rows == [{"Part": "BoltM4", "Makers": "Ames, Bell", "Part_2": "9", "url": "https://parts.example/parts/bolt"},
                    {"Part": "Nut", "Makers": "", "url": ""}]


def test_label_values(spark):
    assert one(spark, FACTS, X.html_label_values)[0]["kv"] == {"area": "14 ha", "height": "3 m"}
    assert one(spark, None, X.html_label_values)[0]["kv"] == {}


def test_info_pairs(spark):
    get = lambda html: one(spark, html, X.html_info_pairs, section_attr=("id", "shelf"))[0]
    assert get(SHELF) == {"id": 1, "kv": {"Room": "North wing", "Subjects": "Maps, Sea & sky", "Volumes": "1,204"}, "error": None}
    assert get("<section></section>") == {"id": 1, "kv": {}, "error": "missing section"}
    assert get(SHELF.replace("Volumes", "Room")) == {"id": 1, "kv": {"Room": "North wing", "Subjects": "Maps, Sea & sky"}, "error": "repeated key Room"}
    assert get(SHELF.replace('class="value">1', 'class="other">1'))["error"] == "missing value"
    assert get(SHELF.replace('<span class="info">Room', "<span>Room"))["error"] == "missing key"
    by_class = one(spark, SHELF, X.html_info_pairs, section_tag="div", section_cls="room")[0]
    assert len(by_class["kv"]) == 3


def test_scope_counts_nested_elements(spark):
    html = "<div class='logo-container'>a<div>b</div><DIV>c<div>d</div></DIV>e</div>f<div>g</div>"
    df = spark.createDataFrame([(html,), ("<div class=\"x logo-container\">open <div>",), ("<p>",), (None,), ("<div>" * 3000,)], "html string")
    got = [r[0] for r in df.select(X.scope("html", "div", "logo-container")).collect()]
    assert got[0].lower() == "a<div>b</div><div>c<div>d</div></div>e" and got[1:4] == ["open <div>", None, None]
    page = "<div class='name-logo'><div></div><img src='/wp-content/uploads/2018/03/a-logo.png'></div><img src='/wp-content/uploads/2001/01/a-logo.png'>"
    date = spark.createDataFrame([(page,)], "html string").select(D.earliest_upload_date(D.logo_scope("html"), "2024-12-31")).first()[0]
    assert str(date) == "2018-03-01"


def test_unclosed_markup_fails_no_task(spark):
    html = "<p>" * 3000 + "<table class='table'><tr><th>A" + "<tr><td>1" * 500 + "<li>" * 3000
    df = spark.createDataFrame([(1, html)], "id long, html string")
    assert X.html_tables(df, ["id"]).count() == 500 and X.html_list_items(df, ["id"]).count() == 3000
    deep = spark.createDataFrame([(1, '{"a":' * 100_000 + '{"ok": 1}')], "id long, text string")
    assert [r.json for r in X.embedded_json(deep, ["id"]).collect()] == ['{"ok": 1}']


def test_list_items(spark):
    html = "<ul><li>a <b>b</b><li><a href='/o&#x27;b?x=1&amp;y'>c&nbsp;d</a></ul><p>e</p>"
    assert [(r["item_idx"], r["item_text"], r["item_href"]) for r in one(spark, html, X.html_list_items)] == [(0, "a b", None), (1, "c d", "/o'b?x=1&y")]


def test_references(spark):
    texts = {"a &amp; b &lt;": "a & b <", "&amp;lt;": "&lt;", "&#65;&#x1F600;&#x41;": "A😀A", "&unknown; & &;": "&unknown; & &;", "&#0;&#1114112;&#xD800;x": "&#0;&#1114112;&#xD800;x",
             "": "", "plain": "plain"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.decode_references("t")).collect()] == list(texts.values())


def test_embedded_json(spark):
    text = 'x = {"t": "A", "n": 3.10, "n": [1, 2]}; junk {not json} and {bad: 1} then {"t":  "B"} {"v": NaN} end {'
    docs = spark.createDataFrame([(1, text), (2, None), (3, "no brace")], "id long, text string")
    found = X.embedded_json(docs, ["id"])
    # as written: spacing, number format and repeated keys stay
    assert [r.json for r in found.orderBy("obj_idx").collect()] == ['{"t": "A", "n": 3.10, "n": [1, 2]}', '{"t":  "B"}']
    first = X.first_with_keys(found, ["id"], ["t", "n"], "t string, n string").collect()
    assert [(r.id, r.obj_idx) for r in first] == [(1, 0)]


def decoded_spans(text):
    """The same spans by the standard decoder, begun anew at every brace."""
    def refuse(name):
        raise ValueError(name)

    decoder, out, at = json.JSONDecoder(parse_constant=refuse), [], text.find("{")
    while at != -1:
        try:
            _, end = decoder.raw_decode(text, at)
            out.append((at, end))
        except ValueError:
            end = at + 1
        at = text.find("{", end)
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(list('{}{}[]"":,, \\') + ['{"a":', '"b"', "1", "-0.5e+3", "01", "1.", "null", "true", "NaN", "-", "\\n", "\\u00e9", "\n", "\x01", "é"]), max_size=30).map("".join))
def test_json_spans_equal_the_decoder(text):
    assert X.json_spans(text) == decoded_spans(text)


def test_json_spans_are_linear_and_have_no_depth():
    deep = '{"a":[' * 100_000 + "]}" * 100_000
    assert X.json_spans("x " + deep + " {}") == [(2, 2 + len(deep)), (3 + len(deep), 5 + len(deep))]
    start = time.monotonic()
    # broken only at their end, so every brace could be a new start
    assert X.json_spans('{"a":' * 50_000 + "[" + "1," * 200_000 + "!") == []
    assert X.json_spans('{"a":{"b":[{"c":1},' * 30_000) == [(i * 19 + 11, i * 19 + 18) for i in range(30_000)]
    assert X.json_spans('{"' * 200_000) == X.json_spans('{"\\"' * 200_000) == X.json_spans("{" * 400_000) == []
    assert X.json_spans('{"a{' * 200_000) == [] and len(X.json_spans('{"x": "{}", ' * 50_000)) == 50_000
    assert time.monotonic() - start < 40


def test_embedded_json_keeps_key_types_and_places(spark):
    docs = spark.sql("""select * from values (1L, date'2024-01-02', decimal(1.50), '{"a":1} {"b":[{}]}'), (null, null, null, 'x {"c":"é{"}'),
                     (3L, null, null, ''), (4L, null, null, null), (5L, null, null, '{ {') t(id, day, amount, text)""")
    docs = docs.unionByName(docs.filter("id = 1"))
    found = X.embedded_json(docs, ["id", "day", "amount"])
    assert dict(found.dtypes)["day"] == "date" and dict(found.dtypes)["amount"].startswith("decimal")
    assert sorted((r.id or 0, str(r.day), r.obj_idx, r.json) for r in found.collect()) == [
        (0, "None", 0, '{"c":"é{"}')] + [(1, "2024-01-02", 0, '{"a":1}')] * 2 + [(1, "2024-01-02", 1, '{"b":[{}]}')] * 2
    assert X.embedded_json(docs.limit(0), ["id"]).count() == 0


def test_script_payload_keeps_the_text_from_the_delimiter(spark):
    df = spark.createDataFrame([(['noise {} STA', 'RT {\\"a\\":\\"b', '\\/c\\"} tail'],)], "parts array<string>")
    row = df.select(X.script_payload(F.col("parts"), "START").alias("cut"), X.script_payload(F.col("parts"), "ABSENT").alias("whole")).first()
    assert row.cut == 'START {"a":"b/c"} tail' and row.whole.startswith("noise {} START")


def test_titles_links_and_frontier(spark):
    html = ('<html><head><title> Foo &amp; Bar (FOO)  price </title></head><body>'
            '<a href="https://h.example/items/foo/.">x</a><a class="n" href="/list?page=3&amp;s=1"><i>Next</i> 3</a>'
            "<a href='https://h.example/o&quot;brien/page'>amp</a><a href=\"/o'brien/page\">o</a></body></html>")
    df = spark.createDataFrame([(1, "https://h.example/items/foo/", html)], "page_id long, url string, html string")
    r = df.select(X.page_title("html").alias("t"), X.entity_name_from_title("html").alias("n"),
                  X.page_size("html").alias("b"), X.url_slug("url").alias("s")).first()
    assert (r.t, r.n, r.s) == ("Foo & Bar (FOO) price", "Foo & Bar", "foo")
    assert [x.hrefs for x in X.pagination_links(df, ["page_id"]).collect()] == [["/list?page=3&s=1"]]
    assert r.b == len(html.encode())
    found = X.links(df, keep=["page_id"])
    assert [x.href for x in found.orderBy("link_idx").collect()] == [
        "https://h.example/items/foo/", "/list?page=3&s=1", 'https://h.example/o"brien/page', "/o'brien/page"]
    direct = X.links(df, keep=["page_id"], predicate=lambda c: P.is_direct_url(c, r"^https://h\.example/items/[^/]+/$")).collect()
    assert [x.href for x in direct] == ["https://h.example/items/foo/"]
    seen = spark.createDataFrame([("https://h.example/items/foo/",)], "url string")
    assert X.frontier_round(found, seen).count() == 3
    c = X.frontier_counts(found, seen).first()
    assert (c.total_count, c.completed_count, c.remaining_count) == (4, 1, 3)
    assert df.select(X.is_valid_entity_page(F.lit("coin-heading" + "x" * 5000))).first()[0] is True


def test_pages_of_a_hot_customer_stay_bounded(spark, tmp_path):
    """A customer with many orders has more pages, not longer ones; the rows are those of one page."""
    from pyspark.sql import functions as F

    from silverline.plans import pages as PG

    orders = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id")).cast("long").alias("o_custkey"), (3001 - F.col("id")).alias("o_orderkey"),
        (F.col("id") + 0.5).alias("o_totalprice"), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    sizes = [len(r.orders) for r in PG._customer_orders(spark, str(tmp_path)).filter("o_custkey = 1").select("orders").collect()]
    assert sum(sizes) == 2000 and max(sizes) <= PG.PAGE_ORDERS
    want = sorted(r.o_orderkey for r in orders.filter("o_custkey = 1").collect())
    for query in (PG.q_page_tables, PG.q_page_grids):
        rows = query(spark, str(tmp_path))
        assert rows.count() == 3000
        name = F.regexp_extract("order_name", "([0-9]+)$", 1).cast("long")
        hot = rows.filter("page_id = 1").select("row_idx", name.alias("k")).orderBy("row_idx").collect()
        assert [tuple(r) for r in hot] == list(enumerate(want))


def test_documents_of_a_hot_customer_stay_bounded(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from silverline.plans import files

    spark.range(20_000).select(F.lit(1).cast("long").alias("o_custkey"), (64 * F.col("id")).alias("o_orderkey"), F.lit("O").alias("o_orderstatus"),
                               F.lit(1.5).alias("o_totalprice")).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(files, "work_dir", lambda *_: f"{tmp_path}/work")
    assert files.q_json_records(spark, str(tmp_path)).select("order_id").distinct().count() == 20_000
    longest = spark.read.text(f"{tmp_path}/work/docs").select(F.max(F.size(F.split("value", "Order Key")))).first()[0]
    assert longest < 200


def test_page_records_read_the_stored_pages(spark, tmp_path):
    """A year and a logo that stand in the page itself are seen."""
    from silverline.plans.reports import q_page_records

    html = ("<title>A (x)</title><p>Opened in 2003, moved in 2011</p><div class='name-logo'><img src='/wp-content/uploads/2004/02/a-logo.png'></div>")
    spark.createDataFrame([(20, "https://a.example.com/en/x", html), (21, "https://a.example.com/en/y", "<p>none</p>")],
                          "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = {r.page_id: r for r in q_page_records(spark, str(tmp_path)).collect()}
    assert (rows[20].earliest_year, rows[20].first_year, rows[20].earliest_logo_date) == (2003, 2003, "2004-02-01")
    assert rows[21].earliest_year == 2019
