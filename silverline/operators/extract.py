"""Page extraction as Spark jobs over a page table (EXT-1..12).

Everything that reads markup is native.  Tables, info lists
and pagers are running counts and aggregates over the token table of
``markup``: a row, cell or item is what its opening tag owns (so optional end
tags need no rule), and a container ends at its own closing tag, whatever it
nests.  Grids (EXT-2) and label cells (EXT-3) follow the same rules on pieces of
the page that stay in its own row, with one row per row of a grid.  Only the scan for JSON objects inside
arbitrary text (EXT-9) runs a small Python helper in ``mapInArrow``: what is an
object's end depends on all the strings and brackets before it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions import predicates as P
from silverline.functions import strings as S
from silverline.operators import markup as M

# Character references by name that pages use in running text.
NAMED_REFERENCES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®",
    "middot": "·", "pound": "£", "euro": "€", "hellip": "…", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»",
}


def decode_references(c: Column | str) -> Column:
    """Decimal, hexadecimal and the named character references above, decoded
    once from left to right; others stay as they are."""
    parts = F.split(S._c(c), "&", -1)
    named = F.create_map(*[F.lit(x) for pair in NAMED_REFERENCES.items() for x in pair])

    def decoded(part: Column) -> Column:
        dec = F.regexp_extract(part, "^#([0-9]{1,7});", 1)
        hexa = F.regexp_extract(part, "^#[xX]([0-9a-fA-F]{1,6});", 1)
        name = F.regexp_extract(part, "^([a-zA-Z]+);", 1)
        point = F.when(dec != "", dec.cast("int")).otherwise(F.conv(F.nullif(hexa, F.lit("")), 16, 10).cast("int"))
        valid = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point)), 8, "0")), "UTF-32")
        rest = F.regexp_replace(part, "^#?[0-9a-zA-Z]+;", "")
        return F.coalesce(F.when((dec != "") | (hexa != ""), F.concat(char, rest)), F.concat(named[name], rest), F.concat(F.lit("&"), part))

    head = F.element_at(parts, 1)
    tail = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded)
    # texts without an ampersand, most of them, skip all of this
    return F.when(F.contains(S._c(c), F.lit("&")), F.concat(head, F.array_join(tail, ""))).otherwise(S._c(c))


_TAG = r"(?s)<!--.*?(?:-->|\z)|<[^<>]*>"


def fragment_text(c: Column | str) -> Column:
    """Text of a fragment, references decoded, white space collapsed."""
    return F.trim(F.regexp_replace(decode_references(F.regexp_replace(S._c(c), _TAG, "")), r"[\s ]+", " "))


def _has_class(cls: str) -> str:
    """Pattern: the tag's class list (either quote) holds ``cls`` as a whole token."""
    quoted = re.escape(cls)
    return rf"""(?=[^<>]*\bclass\s*=\s*(?:"(?:[^"]*\s)?{quoted}(?:\s[^"]*)?"|'(?:[^']*\s)?{quoted}(?:\s[^']*)?'))"""


def open_tag(tag: str, cls: str | None = None, attr: tuple[str, str] | None = None) -> str:
    """Pattern of an opening tag, with a class token or an attribute value if named."""
    more = _has_class(cls) if cls else ""
    if attr:
        more += rf"""(?=[^<>]*\b{re.escape(attr[0])}\s*=\s*["']{re.escape(attr[1])}["'])"""
    return rf"(?is)<(?:{tag})\b{more}[^<>]*>"


def scope(html: Column | str, tag: str, cls: str | None = None, attr: tuple[str, str] | None = None) -> Column:
    """Inner text of the first such element up to its own closing tag: nested
    elements of the same kind are counted.  NULL when there is none; an
    element that never closes runs to the end."""
    opening = open_tag(tag, cls, attr)
    rest = F.get(F.split(S._c(html), opening, 2), F.lit(1))
    pieces = F.split(rest, rf"(?i)</{tag}\s*>", -1)
    # after closing tag n the element is closed if n - 1 others opened before it
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("opened"), F.lit(0).alias("end"))

    def step(state: Column, piece: Column) -> Column:
        n = state["n"] + 1
        opened = state["opened"] + F.size(F.regexp_extract_all(piece, F.lit(rf"(?i)<{tag}\b"), F.lit(0)))
        return F.struct(n.alias("n"), opened.alias("opened"),
                        F.when(state["end"] > 0, state["end"]).when(opened == n - 1, n).otherwise(0).alias("end"))

    end = F.aggregate(pieces, start, step)["end"]
    return F.when(end > 0, F.array_join(F.slice(pieces, F.lit(1), end), f"</{tag}>")).otherwise(rest)


def pieces_after(c: Column | str, opening: str) -> Column:
    """What follows each occurrence of an opening tag, up to the next one."""
    parts = F.split(S._c(c), opening, -1)
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


# An href in either kind of quote; group 2 is the value.
_HREF = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(["'])(.*?)\1"""


def first_href(c: Column | str) -> Column:
    return F.nullif(decode_references(F.regexp_extract(S._c(c), _HREF, 2)), F.lit(""))


def page_title(html: Column | str) -> Column:
    """EXT-5: text of ``<title>``, references decoded, whitespace collapsed, NULL when absent."""
    raw = F.regexp_extract(S._c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return S.clean_text(decode_references(raw))


def entity_name_from_title(html: Column | str, delim: str = " (") -> Column:
    """EXT-5 + STR-18: page title up to the first ``delim``."""
    return S.text_before(page_title(html), delim)


def links(df: DataFrame, html: str = "html", keep: list[str] | None = None,
          predicate=None) -> DataFrame:
    """EXT-6: one row per anchor ``href`` (document order kept as
    ``link_idx``), references decoded, trailing dots stripped, optionally
    filtered by a URL predicate such as ``is_direct_url``."""
    keep = keep or []
    out = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(_HREF), F.lit(2))).alias("link_idx", "href"))
    out = out.withColumn("href", S.rstrip_chars(decode_references("href"), "."))
    return out.filter(predicate(F.col("href"))) if predicate is not None else out


def page_size(html: Column | str) -> Column:
    """EXT-11: size in bytes."""
    return F.octet_length(S._c(html))


def url_slug(url: Column | str) -> Column:
    """EXT-12: last non-empty path segment (query and fragment ignored);
    NULL when the path is empty."""
    path = F.regexp_extract(S._c(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return S.extract_group(path, r"([^/]+)/?$", 1)


def frontier_round(found: DataFrame, seen: DataFrame, url: str = "href") -> DataFrame:
    """EXT-8 / SET-5: one crawl round -- distinct newly found URLs minus URLs
    already seen (``left_anti`` set difference).  Both sides are distributed; nothing is held on the
    driver."""
    return found.select(F.col(url).alias("url")).distinct().join(
        seen.select(F.col("url")), "url", "left_anti")


def frontier_counts(found: DataFrame, seen: DataFrame, url: str = "href") -> DataFrame:
    """EXT-8 counters in one aggregate: total distinct URLs (found + seen),
    completed (seen), remaining (found, not seen)."""
    f = found.select(F.col(url).alias("url"), F.lit(1).alias("_f"), F.lit(0).alias("_s"))
    s = seen.select("url", F.lit(0).alias("_f"), F.lit(1).alias("_s"))
    per = f.unionByName(s).groupBy("url").agg(F.max("_f").alias("f"), F.max("_s").alias("s"))
    return per.agg(F.count(F.lit(1)).alias("total_count"),
                   F.sum("s").cast("bigint").alias("completed_count"),
                   F.count_if((F.col("f") == 1) & (F.col("s") == 0)).alias("remaining_count"))


def is_valid_entity_page(html: Column | str, markers=("coin-heading", "coin-page-hero"),
                         min_size: int = 5000) -> Column:
    """FLT-10 + FLT-11: page holds a marker and has at least ``min_size`` bytes."""
    return P.has_any_marker(html, list(markers)) & P.min_bytes(html, min_size)


# EXT-1, 4 and 7 read the token table: intervals of tokens are grouped by page,
# row and cell on the partitioning that ``tokens`` made, and what an expression
# reads more than once is a column of its own.

def _with_map(df: DataFrame, entries: Column, out: str) -> DataFrame:
    """``out``: a map from (key, value) entries; a later entry replaces an
    earlier one of its key, entries without a key are left out."""
    numbered = F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value")))
    df = df.withColumn("_sorted", F.sort_array(F.filter(numbered, lambda e: e["key"].isNotNull())))
    last = F.filter("_sorted", lambda e, i: F.coalesce(F.get("_sorted", i + 1)["key"] != e["key"], F.lit(True)))
    pairs = F.transform(last, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return df.withColumn(out, F.map_from_entries(pairs)).drop("_sorted")


def _cell_name(headers: Column, i: Column) -> Column:
    return F.coalesce(F.get(headers, i), F.concat(F.lit("_col"), i.cast("string")))


def _entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _keys() -> Column:
    """The keys of a page in an aggregate over its tokens."""
    return F.first("keys").alias("keys")


def _unpacked(key_cols: list[str]) -> list[Column]:
    return [F.col("keys")[c].alias(c) for c in key_cols]


def _text_of_tokens(t: DataFrame, strip: bool) -> DataFrame:
    """References decoded in every run of text; with ``strip`` each stripped."""
    t = t.withColumn("text", F.translate(decode_references("text"), M.NEXT + M.PART, ""))
    return t.withColumn("text", F.btrim("text", F.lit(M.SPACES))) if strip else t


def _collapsed(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(S._c(c), r"[\s ]+", " "))


def _with_href(t: DataFrame) -> DataFrame:
    """``href``: the decoded target of a link's opening tag."""
    return t.withColumn("href", F.when(M.opens("a"), M.attribute("href"))).withColumn("href", F.translate(decode_references("href"), M.NEXT + M.PART, ""))


def _piece_runs(piece: Column) -> Column:
    """The runs of text in a piece, references decoded, each stripped."""
    def run(x: Column) -> Column:
        decoded = F.when(F.contains(x, F.lit("&")), F.translate(decode_references(x), M.NEXT + M.PART, "")).otherwise(x)
        return F.btrim(decoded, F.lit(M.SPACES))

    return F.transform(M.piece_texts(piece), run)


def _piece_text(piece: Column) -> Column:
    """Text of a piece, references decoded and stripped run by run."""
    # most pieces are a tag alone
    return F.when(F.instr(piece, ">") == F.length(piece), "").otherwise(F.array_join(_piece_runs(piece), ""))


def _tags_of(cell: Column, cls: str) -> Column:
    """The texts of a cell's elements of a class, each up to the next closing tag,
    joined by ``", "``; one inside the cell with neither a text right behind its
    tag nor a link begins no new entry."""
    start = M.opening(cls, "a", "div")
    marks = F.transform(M.opened(cell, start, "a", "div"), lambda p: F.struct(p.alias("tag"), _piece_runs(p).alias("runs")))

    def entry(m: Column, i: Column) -> Column:
        linked = M.piece_opens(m["tag"], "a") & (M.piece_quoted(m["tag"], "href") != "")
        begins = (F.get(m["runs"], F.lit(0)) != "") | linked | ((i == 0) & cell.rlike("^" + start))
        return F.concat(F.when(begins, ", ").otherwise(""), F.array_join(m["runs"], ""))

    texts = F.transform(marks, entry)
    return F.substr(F.array_join(texts, ""), F.lit(3))


def _first_hrefs(runs: str) -> Column:
    """The first href in each cell of a row, NULL without one."""
    found = M.intervals(M.joined(runs, M.starts("cell"), lambda x: F.coalesce(F.concat(F.lit(M.PART), x["href"]), F.lit(""))))
    return F.transform(found, lambda c: F.get(F.split(c, M.PART, 3), F.lit(1)))


def _rows_of_runs(t: DataFrame, *fields: str) -> DataFrame:
    """(keys, page, row, runs): the tokens that lie in cells, for every row with its opening tag."""
    telling = F.col("cell").isNotNull() & ((F.col("cell") == F.col("pos")) | (F.col("text") != "") | F.col("href").isNotNull())
    return t.groupBy("page", "row").agg(_keys(), M.runs("cell", "text", "href", *fields, where=telling).alias("runs"))


def _with_heads(rows: DataFrame) -> DataFrame:
    """Rows after the first, with the texts of the first row's cells."""
    first = F.first("texts").over(Window.partitionBy("page").orderBy("row"))
    return rows.withColumn("_plain", first).filter("row > 1")


def html_tables(df: DataFrame, key_cols: list[str], html: str = "html", table_cls: str | None = "table",
                link_mode: str = "all") -> DataFrame:
    """EXT-1: ``(keys..., row_idx, cells map<string,string>)`` of the first
    table (with class ``table_cls``): one row for each table row after the
    first, keyed by the first row's header texts; cells beyond them are
    ``_col<i>``.  ``link_mode="all"`` adds ``<header>_href`` for every linked
    cell, ``"first"`` adds ``link_href`` for a link in the first cell."""
    t = M.inside(M.tokens(df, key_cols, html), "table", M.has_class(table_cls) if table_cls else F.lit(True))
    t = M.counted(t.filter("inside"), "row", M.opens("tr")).filter("row > 0")
    cell = F.when(F.col("row") == 1, M.opens("th")).otherwise(M.opens("td"))
    t = M.owner(t, "cell", cell | M.closes("td", "th") | M.opens("tr"), F.when(cell, 1))
    rows = _rows_of_runs(_with_href(_text_of_tokens(t, True)))
    rows = rows.withColumn("texts", M.intervals(M.joined("runs", M.starts("cell"), lambda x: x["text"]))).withColumn("hrefs", _first_hrefs("runs"))
    rows = _with_heads(rows).withColumn("names", F.transform("texts", lambda _, i: _cell_name(F.col("_plain"), i)))
    if link_mode == "all":
        hrefs = F.zip_with("names", "hrefs", lambda k, h: _entry(F.concat(k, F.lit("_href")), h))
    else:
        hrefs = F.transform(F.slice("hrefs", 1, 1), lambda h: _entry(F.lit("link_href"), h))
    linked = F.filter(hrefs, lambda e: e["value"] != "")
    rows = _with_map(rows, F.concat(linked, F.zip_with("names", "texts", _entry)), "cells")
    return rows.select(*_unpacked(key_cols), (F.col("row") - 2).cast("int").alias("row_idx"), "cells")


def html_grid(df: DataFrame, key_cols: list[str], html: str = "html", container: str = "box_table", row_cls: str = "tr",
              head_cls: str = "th", cell_cls: str = "td", tag_cls: str = "tag", link_col: str | None = None,
              base_url: str = "", url_col: str = "url") -> DataFrame:
    """EXT-2: ``(keys..., row_idx, cells map<string,string>)`` from a grid of
    ``div`` rows; the first row holds the headers (a repeated header gets
    ``_2``, ``_3``).  A cell with elements of class ``tag_cls`` is their texts
    joined by ``", "``.  The link of the cell named ``link_col``, made absolute
    with ``base_url``, is added as ``url_col`` (``""`` when there is none)."""
    def marked(row: Column, cls: str) -> Column:
        # the row's own tag may be a cell too
        return F.regexp_replace(F.concat(F.lit("<"), row), M.opening(cls, "div"), M.NEXT + "<")

    pages = M.pages(df, key_cols, html).withColumn("_html", M.unmarked("_html"))
    pages = M.inside_first(pages, "_html", container, "div").select("keys", M.after_first(M.cut_at("_html", M.opening(row_cls, "div"))).alias("_rows"))
    pages = pages.withColumn("_plain", F.transform(M.intervals(marked(F.get("_rows", F.lit(0)), head_cls)), _piece_text))
    nth = F.transform("_plain", lambda h, i: F.size(F.filter(F.slice("_plain", F.lit(1), i + 1), lambda x: x == h)))
    heads = F.zip_with("_plain", nth, lambda h, n: F.when(n == 1, h).otherwise(F.concat(h, F.lit("_"), n.cast("string"))))
    rows = pages.select("keys", heads.alias("_heads"), F.posexplode(M.after_first(F.col("_rows"))).alias("row_idx", "_row"))
    rows = rows.withColumn("_row", marked(F.col("_row"), cell_cls)).withColumn("_cells", M.intervals(F.col("_row")))
    texts = F.when(F.contains("_row", F.lit("&")), F.transform("_cells", _piece_text)).otherwise(M.plain_texts("_row"))
    tags = F.transform("_cells", lambda c: F.when(F.contains(c, F.lit(tag_cls)), _tags_of(c, tag_cls)).otherwise(""))
    rows = rows.withColumn("names", F.transform("_cells", lambda _, i: _cell_name(F.col("_heads"), i)))
    at = F.array_position("names", F.lit(link_col)) if link_col else F.lit(0)
    linked = F.when(at > 0, F.get("_cells", (at - 1).cast("int")))
    rows = rows.withColumn("_href", M.first_quoted(linked, "a", "href")).withColumn("_href", M.unquoted("_href"))
    rows = rows.withColumn("_href", F.when(F.contains("_href", F.lit("&")), F.translate(decode_references("_href"), M.NEXT + M.PART, "")).otherwise(F.col("_href")))
    href = F.col("_href")
    absolute = F.when(F.coalesce(href, F.lit("")) == "", "").when(href.rlike(r"^[a-z]+://"), href).otherwise(
        F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace(href, "^/+", "")))
    values = F.zip_with(tags, texts, lambda tags, text: F.when(tags != "", tags).otherwise(text))
    rows = _with_map(rows, F.concat(F.zip_with("names", values, _entry), F.array(_entry(F.lit(url_col), absolute))), "cells")
    return rows.select(*_unpacked(key_cols), "row_idx", "cells")


def html_label_values(df: DataFrame, key_cols: list[str], html: str = "html", label_cls: str = "label", value_cls: str = "value",
                      ignore_cls: tuple[str, ...] = ("label", "coin_type")) -> DataFrame:
    """EXT-3: ``(keys..., kv map<string,string>)``: table rows with a label
    and a value cell; the key is the label cell's first class that is not in
    ``ignore_cls``; a later key replaces an earlier one."""
    pages = M.pages(df, key_cols, html).withColumn("_html", F.coalesce(M.unmarked("_html"), F.lit("")))
    # a row without both names has no pair
    rows = F.filter(M.after_first(M.cut("_html", "tr", closing=False)), lambda row: F.contains(row, F.lit(label_cls)) & F.contains(row, F.lit(value_cls)))

    def first_cell(cells: Column, cls: str) -> Column:
        return F.get(F.filter(cells, lambda c: M.piece_opens(c, "td") & M.piece_has_class(c, cls)), F.lit(0))

    def entry(row: Column) -> Column:
        names = F.split(F.btrim(M.piece_attribute(row["label"], "class"), F.lit(M.SPACES)), r"\s+")
        key = F.get(F.filter(names, lambda c: (c != "") & ~c.isin(*ignore_cls)), F.lit(0))
        return _entry(F.when(row["value"].isNotNull(), key), _piece_text(row["value"]))

    cells = F.transform(rows, lambda row: M.after_first(M.cut(row, "td", "tr")))
    pairs = F.transform(cells, lambda c: F.struct(first_cell(c, label_cls).alias("label"), first_cell(c, value_cls).alias("value")))
    return _with_map(pages, F.transform(pairs, entry), "kv").select(*_unpacked(key_cols), "kv")


def html_info_pairs(df: DataFrame, key_cols: list[str], html: str = "html", section_tag: str = "section",
                    section_cls: str | None = None, section_attr: tuple[str, str] | None = None, key_cls: str = "info",
                    value_cls: str = "value", hidden_cls: str = "hidden") -> DataFrame:
    """EXT-4: ``(keys..., kv map<string,string>, error string)`` from the list
    items of one section: hidden items are skipped; an item with links takes
    their texts joined by ``", "``.  A missing section, key or value and a
    repeated key without links are errors: the pairs before the first error
    are kept, and a contract decides about the row."""
    hit = M.has_class(section_cls) if section_cls else F.lit(True)
    if section_attr:
        hit = hit & M.has_attribute(*section_attr)
    t = M.inside(M.tokens(df, key_cols, html), section_tag, hit)
    # a page without the section keeps its first token
    t = t.filter(F.col("inside") | (F.col("pos") == 0))
    t = M.owner(t, "item", M.opens("li") & F.col("inside"), F.when(M.has_class(hidden_cls), 0).otherwise(1))
    kind = F.when(M.opens("span") & M.has_class(key_cls), "key").when(M.opens("span") & M.has_class(value_cls), "value")
    t = M.owner(t.withColumn("_kind", kind), "span", F.col("_kind").isNotNull() | M.closes("span") | M.opens("li"), F.col("_kind"))
    t = M.owner(t, "link", M.opens("li", "a") | M.closes("a"), F.when(M.opens("a"), 1))
    t = _text_of_tokens(t, False)
    items = t.groupBy("page", "item").agg(
        _keys(), F.max("inside").alias("found"), F.max("item_kind").alias("shown"),
        *[M.runs("span", "text", where=F.col("span_kind") == k).alias(f"_{k}") for k in ("key", "value")],
        M.runs("link", "text", where=F.col("link").isNotNull()).alias("_link"))
    # the first span of each kind
    for k in ("key", "value"):
        own = F.filter(f"_{k}", lambda r: r["span"] == F.get(f"_{k}", F.lit(0))["span"])
        items = items.withColumn(k, F.when(F.size(f"_{k}") > 0, _collapsed(M.joined(own, lambda x: x["text"]))))
    items = items.withColumn("links", F.transform(M.intervals(M.joined("_link", M.starts("link"), lambda x: x["text"])), _collapsed))
    listed = F.when((F.col("shown") == 1), F.struct("item", "key", "links", "value"))
    base = items.groupBy("page").agg(_keys(), (~F.max("found")).alias("_none"), F.sort_array(F.collect_list(listed)).alias("_items"))
    base = base.withColumn("_keys", F.transform("_items", lambda e: e["key"]))

    def error(e: Column, i: Column) -> Column:
        plain = F.size(e["links"]) == 0
        return (F.when(e["key"].isNull(), "missing key").when(plain & e["value"].isNull(), "missing value")
                .when(plain & F.array_contains(F.slice("_keys", F.lit(1), i), e["key"]), F.concat(F.lit("repeated key "), e["key"])))

    base = base.withColumn("_errors", F.transform("_items", error))
    base = base.withColumn("_first", F.get(F.filter(F.transform("_errors", lambda e, i: F.when(e.isNotNull(), i)), lambda i: i.isNotNull()), F.lit(0)))
    good = F.slice("_items", F.lit(1), F.coalesce("_first", F.size("_items")))
    pairs = F.transform(good, lambda e: _entry(e["key"], F.when(F.size(e["links"]) > 0, F.array_join(F.filter(e["links"], lambda t: t != ""), ", ")).otherwise(e["value"])))
    error_text = F.when(F.col("_none"), "missing section").otherwise(F.get("_errors", F.col("_first")))
    return _with_map(base, pairs, "kv").select(*_unpacked(key_cols), "kv", error_text.alias("error"))


def pagination_links(df: DataFrame, key_cols: list[str], html: str = "html") -> DataFrame:
    """EXT-7: ``(keys..., hrefs array<string>)``: in page order the hrefs of
    the anchors whose text starts with ``Next <n>``, whatever elements stand
    inside the anchor before the text; an empty array when there is none."""
    t = M.owner(M.tokens(df, key_cols, html), "link", M.opens("a") | M.closes("a"), F.when(M.opens("a"), 1))
    telling = F.col("link").isNotNull() & ((F.col("text") != "") | F.col("href").isNotNull())
    pages = _with_href(_text_of_tokens(t, False)).groupBy("page").agg(_keys(), M.runs("link", "text", "href", where=telling).alias("runs"))
    anchors = M.intervals(M.joined("runs", M.starts("link"), lambda x: F.when(x["link"] == x["pos"], F.concat(F.coalesce(x["href"], F.lit("")), F.lit(M.PART))).otherwise(""),
                                   lambda x: x["text"]))
    pages = pages.withColumn("_links", F.transform(anchors, lambda c: F.split(c, M.PART, 2)))
    wanted = F.filter("_links", lambda c: (c[0] != "") & F.ltrim(_collapsed(c[1])).rlike(r"^Next \d+"))
    return pages.select(*_unpacked(key_cols), F.transform(wanted, lambda c: c[0]).alias("hrefs"))


def html_list_items(df: DataFrame, key_cols: list[str], html: str = "html") -> DataFrame:
    """EXT-4 style over any page: ``(keys..., item_idx, item_text, item_href)``."""
    items = F.transform(pieces_after(F.col(html), open_tag("li")), lambda li: F.regexp_replace(li, r"(?is)</(?:li|ul|ol)\s*>.*$", ""))
    out = df.select(*key_cols, F.posexplode(items).alias("item_idx", "_li"))
    return out.select(*key_cols, "item_idx", fragment_text("_li").alias("item_text"), first_href("_li").alias("item_href"))


def script_payload(fragments: Column, start: str | None = None) -> Column:
    """EXT-9 preamble: script fragments joined, ``\\"`` and ``\\/`` unescaped,
    and the text FROM the delimiter on (all of it when absent)."""
    text = F.replace(F.replace(F.array_join(fragments, ""), F.lit('\\"'), F.lit('"')), F.lit("\\/"), F.lit("/"))
    if start is None:
        return text
    at = F.position(F.lit(start), text)
    return F.when(at > 0, F.substr(text, at)).otherwise(text)


# One token of JSON, with the white space before it.  Possessive, so that a
# long string is read once and keeps no way back.
_TOKEN = re.compile(r"""[ \t\n\r]*+(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+")"""
                    r"""|(-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?+[0-9]++)?+|true|false|null))""")

#: What may come next inside an object or array.
_VALUE, _KEY, _KEY_OR_END, _COLON, _COMMA_OR_END, _VALUE_OR_END = range(6)


def _scan_object(text: str, start: int, ends: dict[int, int]) -> int:
    """The end of the JSON object that starts at the brace ``start``, -1 if
    none does.  Open objects and arrays are kept on a list, so nesting has no
    limit.  ``ends`` keeps what was found of every brace met as a value, so
    that no text is scanned again for the objects inside a broken one."""
    opened, at, wanted = [(start, "}")], start + 1, _KEY_OR_END
    while True:
        token = _TOKEN.match(text, at)
        if token is None:
            break
        mark, string, _ = token.groups()
        at = token.end()
        if wanted in (_VALUE, _VALUE_OR_END):
            if mark == "{":
                known = ends.get(at - 1)
                if known is None:
                    opened.append((at - 1, "}"))
                    wanted = _KEY_OR_END
                elif known < 0:
                    break
                else:
                    at, wanted = known, _COMMA_OR_END
                continue
            if mark == "[":
                opened.append((-1, "]"))
                wanted = _VALUE_OR_END
                continue
            if mark is None:
                wanted = _COMMA_OR_END
                continue
        elif wanted in (_KEY, _KEY_OR_END) and string is not None:
            wanted = _COLON
            continue
        elif wanted == _COLON and mark == ":":
            wanted = _VALUE
            continue
        elif wanted == _COMMA_OR_END and mark == ",":
            wanted = _KEY if opened[-1][1] == "}" else _VALUE
            continue
        if wanted not in (_KEY_OR_END, _VALUE_OR_END, _COMMA_OR_END) or mark != opened[-1][1]:
            break
        begin, _ = opened.pop()
        if begin >= 0:
            ends[begin] = at
        if not opened:
            return at
        wanted = _COMMA_OR_END
    # what holds the place that is no JSON is none either
    ends.update((begin, -1) for begin, _ in opened if begin >= 0)
    return -1


def json_spans(text: str | None) -> list[tuple[int, int]]:
    """EXT-9: where JSON objects stand in a text, left to right; each ``{``
    that starts a valid object yields it, however deep it nests, and the scan
    goes on behind it.  ``NaN`` and ``Infinity`` are no JSON."""
    out: list[tuple[int, int]] = []
    ends: dict[int, int] = {}
    at = (text or "").find("{")
    while at != -1:
        end = ends.get(at) or _scan_object(text, at, ends)
        if end > 0:
            out.append((at, end))
        at = text.find("{", end if end > 0 else at + 1)
    return out


def json_objects(text: str | None) -> list[str]:
    """EXT-9: the objects of ``json_spans``, as they are written."""
    return [text[a:b] for a, b in json_spans(text)]


#: Bytes of text whose objects leave a task as one batch (one text, if that is longer).
_SLICE_BYTES = 4 << 20


def embedded_json(df: DataFrame, key_cols: list[str], text: str = "text") -> DataFrame:
    """EXT-9: ``(keys..., obj_idx, json)`` for every JSON object embedded in
    the text, as written there (parse further with ``from_json``).  A null or
    empty text and a text without an object give no row."""
    from silverline.session import ship_package

    ship_package(df.sparkSession)
    names = [*key_cols, "obj_idx", "json"]

    def run(batches):
        for batch in batches:
            keys, docs = pa.Table.from_batches([batch.select(key_cols)]), batch.column(text)
            sizes = np.nan_to_num(pc.binary_length(docs).to_numpy(zero_copy_only=False).astype("f8"))
            for rows in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(np.cumsum(sizes) // _SLICE_BYTES)) + 1):
                found = [json_objects(doc) for doc in docs.take(pa.array(rows)).to_pylist()]
                counts = np.array([len(f) for f in found], "i8")
                places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                objects = pa.array([o for f in found for o in f], docs.type)
                columns = [*keys.take(pa.array(np.repeat(rows, counts))).columns, pa.chunked_array([places.astype("i4")]), pa.chunked_array([objects])]
                yield from pa.Table.from_arrays(columns, names).combine_chunks().to_batches()

    keys = T.StructType([df.schema[c] for c in key_cols])
    # a text without a brace holds no object and need not leave the JVM
    return df.select(*key_cols, text).filter(F.contains(text, F.lit("{"))).mapInArrow(run, T.StructType([*keys, T.StructField("obj_idx", T.IntegerType()), T.StructField("json", T.StringType())]))


def first_with_keys(objs: DataFrame, key_cols: list[str], required: list[str], schema: str) -> DataFrame:
    """EXT-10: per document, the first embedded object (by ``obj_idx``) that
    holds every required key.  ``min`` of a struct: no window, no sort."""
    parsed = objs.withColumn("_o", F.from_json("json", schema))
    ok = parsed.filter(F.expr(" AND ".join(f"_o.`{k}` IS NOT NULL" for k in required)))
    best = ok.groupBy(*key_cols).agg(F.min(F.struct("obj_idx", "json")).alias("_b"))
    return best.select(*key_cols, F.col("_b.obj_idx").alias("obj_idx"), F.col("_b.json").alias("json"))
