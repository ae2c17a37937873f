"""The token table: tags, text, depth and intervals."""

import time

from pyspark.sql import functions as F

from silverline.operators import extract as X
from silverline.operators import markup as M


def frame(spark, *pages):
    return spark.createDataFrame(list(enumerate(pages)), "page long, html string")


def test_tokens(spark):
    got = M.tokens(frame(spark, "a<P class='x y'>b < c<!-- <p> --></p >d<br/>e<", None, ""), ["page"]).orderBy("keys.page", "pos").collect()
    assert [(t["keys"].page, t.pos, t.tag, t.closing, t.attrs, t.text) for t in got] == [
        (0, 0, "", False, None, "a"), (0, 1, "p", False, "P class='x y'", "b "), (0, 2, "", False, None, "< c"), (0, 3, "p", True, "/p ", "d"),
        (0, 4, "br", False, "br/", "e"), (0, 5, "", False, None, "<"), (1, 0, "", False, None, None), (2, 0, "", False, None, "")]


def test_attributes(spark):
    html = """<a HREF = "/x?a=1&amp;b" class=plain id='it'><a class='one  two'><a data-href='/no' title="class='one'"><a href=><a href="/v='1'">"""
    t = M.tokens(frame(spark, html), ["page"]).filter("tag = 'a'").orderBy("pos")
    assert [tuple(r) for r in t.select(M.attribute("href"), M.has_class("one"), M.has_class("plain"), M.has_attribute("id", "it")).collect()] == [
        ("/x?a=1&amp;b", False, True, True), (None, True, False, False), (None, False, False, False), (None, False, False, False), ("/v='1'", False, False, False)]


def test_inside_ends_at_its_own_closing_tag(spark):
    pages = ("<div>x<div class='c'>a<div>b</div></div>out</div><div class='c'>no", "</div><div class='c'>open<p>", "<p>none")
    t = M.inside(M.tokens(frame(spark, *pages), ["page"]), "div", M.has_class("c")).filter("inside")
    got = t.groupBy("keys.page").agg(F.array_join(M.runs("text")["text"], "|").alias("t")).orderBy("page").collect()
    assert [tuple(r) for r in got] == [(0, "a|b|"), (1, "open|")]


def test_owner_is_the_latest_event(spark):
    t = M.owner(M.tokens(frame(spark, "0<a>1<b>2</b>3</a>4<a>5<a>6"), ["page"]), "link", M.opens("a") | M.closes("a"), F.when(M.opens("a"), 1))
    assert [(r.text, r.link) for r in t.orderBy("pos").collect()] == [("0", None), ("1", 1), ("2", 1), ("3", 1), ("4", None), ("5", 5), ("6", 6)]


def test_repeated_rows_and_key_names_of_tokens(spark):
    df = spark.createDataFrame([("k", "v", "<table class='table'><tr><th>text<tr><td>1<td>2</table>")] * 2, "text string, row string, html string")
    rows = X.html_tables(df, ["text", "row"]).collect()
    assert [(r.text, r.row, r.row_idx, r.cells) for r in rows] == [("k", "v", 0, {"text": "1", "_col1": "2"})] * 2
    assert X.html_tables(df.limit(0), ["text"]).count() == 0 and X.pagination_links(df.limit(0), ["text"]).count() == 0


def test_marks_in_the_text_do_not_cut_cells(spark):
    html = "<table class='table'><tr><th>A<tr><td>x\x1ey&#30;&#x1f;z<td><a href='/q\x1f'>w</a></table>"
    assert X.html_tables(frame(spark, html), ["page"]).first().cells == {"A": "xyz", "_col1": "w", "_col1_href": "/q"}


def test_linear_in_the_page(spark):
    """Pages of nothing but the worst characters take seconds."""
    bad = frame(spark, *[c * (300_000 // len(c)) for c in ("<", "<!--", "<a ", "<div class='", "<td class='label", "&", "<!-- <td>")])
    for query in (X.html_tables, X.html_grid, X.html_label_values, X.html_info_pairs, X.pagination_links):
        began = time.time()
        query(bad, ["page"]).collect()
        assert time.time() - began < 60
    began = time.time()
    bad.select(F.max(F.length(X.fragment_text("html")))).collect()
    assert time.time() - began < 60


def test_label_cells_are_read_inside_their_page(spark):
    """no row, sort or window per tag; the rules of the token table hold."""
    odd = ("<TR><td class='label a'>A<td class=value> x <b> y&#32;</b>< z\x1e</td>out<td class='value'>second</tr>"
           "<tr><td class='label'><td class='value'>no key<tr><td class=\"label b\">B<td data-class='value' class=\"'value'\">no value"
           "<trx><tr><td class='coin_type label a'><!-- </td> --><td class='x\tvalue'>a > &amp;lt;<td><td_x class='label c'>")
    df = X.html_label_values(frame(spark, odd, None, "<td class='label a'><td class='value'>no row"), ["page"])
    assert [dict(r.kv) for r in df.orderBy("page").collect()] == [{"a": "a > &lt;"}, {}, {}]
    first = X.html_label_values(frame(spark, odd.split("<tr><td class='coin_type")[0]), ["page"]).first()
    assert dict(first.kv) == {"a": "xy< z"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan and "Generate" not in plan and "Aggregate" not in plan


def test_grid_is_read_inside_its_page(spark):
    """no row, sort or window per tag; the rules of the token table hold."""
    odd = ("<div class='tr'>before</div><!-- <div class='box_table'> --><DIV title=\"class='x'\" class=\"wide\tbox_table\"><div>"
           "<div class=tr><div class='th x'> A&amp;<b> b </b><div class='th'>L<div class='th'>L</div></div>stray"
           "<div class='tr td'> own &#32; text<div class='td'>< 1<a>no</a><a HREF=\"//q?a=1&amp;b='2'\">\x1ec </a>d&#30;<div class='td tag'><b> in </b></div>out"
           "<div class='tdx td'>w<a class='tag' href=''></a><div class=\"tag x\"> y > &lt;z </div>left<div class=tag><i></i></div></div></div>"
           "<div class=\"tr\"></div><div class='tr'><div data-class='td'>none<div class='th'>none</div></div></div></div></div><div class='tr'><div class='td'>outside</div></div>")
    df = X.html_grid(frame(spark, odd, None, "", "<div class='box_table'><div class='tr'><div class='td'>no head</div></div>"), ["page"], link_col="L", base_url="https://e.org")
    rows = [(r.page, r.row_idx, r.cells) for r in df.orderBy("page", "row_idx").collect()]
    assert rows == [(0, 0, {"A&b": "own   text", "L": "< 1nocd", "Lstray": "in", "_col3": ", y > <z", "url": "https://e.org/q?a=1&b='2'"}),
                    (0, 1, {"url": ""}), (0, 2, {"url": ""}), (0, 3, {"A&b": "outside", "url": ""})]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan and "Aggregate" not in plan


def test_grid_tags_are_read_in_linear_time(spark):
    """patterns over a whole page do not go back over what they read."""
    start = "<div class='box_table'><div class='tr'><div class='th'>A</div></div><div class='tr'><div class='td'>"
    bad = frame(spark, *[start + c * (300_000 // len(c)) for c in (" ", " x", "<div class='td ", "td <div class=\"td td ", "<", "</a ", "<div class ", " class='")],
                *["<div class='box_table" + c * (300_000 // len(c)) for c in (" tr td", " class='", ' class="')])
    began = time.time()
    X.html_grid(bad, ["page"]).collect()
    assert time.time() - began < 60
