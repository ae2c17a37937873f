"""Markup as a token table: every page is cut into its tags once, and what
extraction asks for are running counts and aggregates over it.

``tokens`` gives one row per tag with the text after it; ``inside`` marks the
tokens of the first matching element by a running depth; ``owner`` gives every
token the latest of some events before it, so a cell, a link or a list item is
the interval of tokens that one opening tag owns.  A page is moved once, as its
markup, and all of this runs on that partitioning.  Every step is linear in the
page: a tag ends at the next ``>`` and holds no ``<``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space that is stripped and collapsed.
SPACES = " \t\n\r\f\v"


def _in_order():
    return Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def pages(df: DataFrame, key_cols: list[str], html: str = "html") -> DataFrame:
    """(keys, page, _html): the pages without their comments, one that never
    ends up to the end of the page."""
    keys = F.struct(*[F.col(f"`{c}`") for c in key_cols]).alias("keys")
    page = df.select(keys, F.monotonically_increasing_id().alias("page"), F.col(html).alias("_html"))
    # a page is little to move and much to work on: as many tasks as the session has for a shuffle
    page = page.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page")
    plain = F.when(F.contains("_html", F.lit("<!--")), F.regexp_replace("_html", r"(?s)<!--.*?(?:-->|\z)", "")).otherwise(F.col("_html"))
    return page.select("keys", "page", plain.alias("_html"))


def tokens(df: DataFrame, key_cols: list[str], html: str = "html") -> DataFrame:
    """(keys, page, pos, tag, closing, attrs, text): one row per tag in page
    order, and one at ``pos`` 0 for what stands before the first, so that every
    page has a row.  ``keys`` is a struct of the key columns.  ``tag`` is in lower case, empty for ``<`` that opens none
    and for other markup; ``text`` is the text up to the next tag, as written.  Comments are
    left out, one that never ends up to the end of the page."""
    page = pages(df, key_cols, html)
    cut = page.select("keys", "page", F.posexplode_outer(F.split("_html", "<", -1)).alias("pos", "_part"))
    end = F.when(F.col("pos") > 0, F.instr("_part", ">")).otherwise(0)
    cut = cut.withColumn("pos", F.coalesce("pos", F.lit(0))).withColumn("_end", end)
    is_tag = F.col("_end") > 0
    attrs = F.when(is_tag, F.expr("substring(_part, 1, _end - 1)"))
    text = F.when(is_tag, F.expr("substring(_part, _end + 1)")).when(F.col("pos") > 0, F.concat(F.lit("<"), "_part")).otherwise(F.col("_part"))
    cut = cut.select("keys", "page", "pos", attrs.alias("attrs"), text.alias("text"))
    name = F.lower(F.regexp_extract("attrs", r"^/?([a-zA-Z][a-zA-Z0-9-]*+)", 1))
    return cut.select("keys", "page", "pos", F.coalesce(name, F.lit("")).alias("tag"),
                      F.coalesce(F.startswith("attrs", F.lit("/")), F.lit(False)).alias("closing"), "attrs", "text")


def opens(*tags: str) -> Column:
    return F.col("tag").isin(*tags) & ~F.col("closing")


def closes(*tags: str) -> Column:
    return F.col("tag").isin(*tags) & F.col("closing")


def unquoted(value: Column | str) -> Column:
    found = F.col(value) if isinstance(value, str) else value
    quoted = F.substring(found, 1, 1).isin('"', "'")
    return F.when(quoted, F.substr(found, F.lit(2), F.length(found) - 2)).when(found != "", found)


def attribute(name: str) -> Column:
    """Value of an attribute in either kind of quotes or none, as written; NULL without it."""
    return unquoted(F.regexp_extract("attrs", rf"""(?is)\s{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", 1))


def classes() -> Column:
    return F.split(F.btrim(attribute("class"), F.lit(SPACES)), r"\s+")


def has_class(name: str) -> Column:
    """The class list holds the name as a whole; cheap where the name does not occur."""
    return F.when(F.contains("attrs", F.lit(name)), F.coalesce(F.array_contains(classes(), name), F.lit(False))).otherwise(False)


def has_attribute(name: str, value: str) -> Column:
    return F.when(F.contains("attrs", F.lit(value)), F.coalesce(attribute(name) == value, F.lit(False))).otherwise(False)


def inside(t: DataFrame, tag: str, hit: Column) -> DataFrame:
    """``t`` with ``inside``: the token lies in the first ``tag`` element where
    ``hit`` holds, from its opening tag on to before its own closing tag;
    elements of the same kind that it nests are counted."""
    first = F.min(F.when(opens(tag) & hit, F.col("pos"))).over(_in_order())
    t = t.withColumn("_first", first)
    step = F.when(F.col("_first").isNotNull() & (F.col("tag") == tag), F.when(F.col("closing"), -1).otherwise(1)).otherwise(0)
    t = t.withColumn("_depth", F.sum(step).over(_in_order()))
    ended = F.min(F.when(F.col("_first").isNotNull(), F.col("_depth"))).over(_in_order()) < 1
    return t.withColumn("inside", F.col("_first").isNotNull() & ~ended).drop("_first", "_depth")


def counted(t: DataFrame, name: str, event: Column) -> DataFrame:
    """``t`` with the number of events up to the token."""
    return t.withColumn(name, F.sum(event.cast("int")).over(_in_order()))


def owner(t: DataFrame, name: str, event: Column, kind: Column) -> DataFrame:
    """``t`` with ``name``: the place of the latest event at or before the token
    if ``kind`` is not NULL there, and ``name_kind``; NULL where nothing owns it."""
    latest = F.max(F.when(event, F.struct(F.col("pos").alias("at"), kind.alias("kind")))).over(_in_order())
    t = t.withColumn("_latest", latest)
    return (t.withColumn(name, F.when(F.col("_latest.kind").isNotNull(), F.col("_latest.at")))
            .withColumn(f"{name}_kind", F.col("_latest.kind")).drop("_latest"))


#: Marks between the intervals of a row and within one; no text of a token holds them.
NEXT, PART = "\x1e", "\x1f"


def runs(*fields: str, where: Column | None = None) -> Column:
    """Aggregate: the tokens' fields as an array of structs in page order."""
    item = F.struct("pos", *fields)
    return F.sort_array(F.collect_list(F.when(where, item) if where is not None else item))


def joined(items: Column | str, *parts) -> Column:
    """The ``parts`` of every run of an array of ``runs``, functions of the run, one after another."""
    def piece(x: Column) -> Column:
        return F.concat(*[part(x) for part in parts])

    return F.array_join(F.transform(items, piece), "")


def starts(interval: str, mark: str = NEXT):
    """Part: ``mark`` before the run that opens its interval."""
    return lambda x: F.when(x[interval] == x["pos"], mark).otherwise("")


def intervals(text: Column, mark: str = NEXT) -> Column:
    """The pieces of a joined text behind each mark."""
    pieces = F.split(text, mark, -1)
    return F.slice(pieces, 2, 2**30)


# What asks only for whole rows and cells needs no row per tag: the page is cut
# at the tags that bound them, and the pieces stay in the page's own row.  A
# piece starts with its tag, without the ``<``.

def cut_at(html: Column | str, start: str) -> Column:
    """The pieces from each place where the pattern takes one character, left out,
    up to the next; first what stands before all of them.  ``html`` holds no marks."""
    # the pattern of a replacement is compiled once, that of a split for every row
    return F.split(F.regexp_replace(html, start, NEXT), NEXT, -1)


def cut(html: Column | str, *tags: str, closing: bool = True) -> Column:
    """The pieces from each of these tags, opening or ``closing`` too, up to the
    next; first what stands before all of them.  ``html`` holds no marks."""
    return cut_at(html, rf"(?i)<(?={'/?' if closing else ''}(?:{'|'.join(tags)})(?![a-z0-9-])[^<>]*>)")


def opening(cls: str, *tags: str) -> str:
    """Pattern: the ``<`` of an opening tag whose first class attribute holds the
    name as a whole.  What it tries is bounded by the tag, which is read a fixed number of times."""
    value = "|".join(rf"{q}(?:[^{q}<>]*\s)?\Q{cls}\E(?:\s[^{q}<>]*)?{q}" for q in ('"', "'"))
    first = r"""[^<>]*?\s(?i:class)\s*+=\s*+(?="[^"<>]*+"|'[^'<>]*+'|[^\s"'<>])"""
    return rf"""<(?=(?i:{'|'.join(tags)})(?![a-zA-Z0-9-])(?=[^<>]*+>)(?>{first})(?:{value}|\Q{cls}\E(?=[\s"'>])))"""


def inside_first(df: DataFrame, html: str, cls: str, tag: str) -> DataFrame:
    """``df`` with the markup cut down to its first ``tag`` element of the class,
    from its opening tag on to before its own closing tag; elements of the same
    kind that it nests are counted.  Empty without one."""
    df = df.withColumn("_pieces", cut(F.regexp_extract(html, opening(cls, tag) + r"(?s:.*+)", 0), tag))
    # one number, cheap to fold: how many elements are open, times 2^32, plus the pieces read
    one = 1 << 32

    def step(at: Column, piece: Column) -> Column:
        return F.when(at >= one, at + F.when(F.startswith(piece, F.lit("/")), 1 - one).otherwise(1 + one)).otherwise(at)

    # the second piece is the element's own opening tag; the one that closes it is read but not kept
    df = df.withColumn("_read", F.aggregate(F.slice("_pieces", 3, 2**30), F.lit(one + 1), step))
    kept = F.when(F.col("_read") >= one, F.size("_pieces")).otherwise(F.col("_read").cast("int") - 1)
    # each piece lost the ``<`` it began with
    return df.withColumn(html, F.array_join(F.concat(F.array(F.lit("")), F.slice("_pieces", F.lit(2), kept)), "<")).drop("_pieces", "_read")


def unmarked(html: str) -> Column:
    """A column of markup without the marks that cutting sets."""
    return F.when(F.contains(html, F.lit(NEXT)) | F.contains(html, F.lit(PART)), F.translate(html, NEXT + PART, "")).otherwise(F.col(html))


def after_first(items: Column) -> Column:
    return F.slice(items, 2, 2**30)


def piece_opens(piece: Column, tag: str) -> Column:
    """A piece of ``cut`` begins with the opening tag; no other tag cut at may start with its name."""
    return F.lower(F.substring(piece, 1, len(tag))) == tag


def piece_quoted(piece: Column, name: str) -> Column:
    """Value of an attribute of a piece's tag as ``attribute`` finds it, in its quotes; empty without it."""
    return F.regexp_extract(F.substring_index(piece, ">", 1), rf"""(?is)\s{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", 1)


def piece_attribute(piece: Column, name: str) -> Column:
    """Value of an attribute of a piece's tag, as written; empty without it."""
    return F.regexp_replace(piece_quoted(piece, name), r"""(?s)^(["'])(.*)\1\z""", "$2")


def piece_has_class(piece: Column, name: str) -> Column:
    whole = rf"""(?s)^(["']?)(?:.*\s)?\Q{name}\E(?:\s.*)?\1\z"""
    return F.when(F.contains(piece, F.lit(name)), piece_quoted(piece, "class").rlike(whole)).otherwise(False)


def first_quoted(html: Column, tag: str, name: str) -> Column:
    """Value of the attribute in the first opening ``tag`` that has it, in its quotes; empty without one."""
    value = r"""("[^"<>]*+"|'[^'<>]*+'|[^\s"'<>]++)"""
    return F.regexp_extract(html, rf"(?i)<{tag}(?![a-z0-9-])(?=[^<>]*+>)[^<>]*?\s{name}\s*+=\s*+{value}", 1)


def opened(html: Column, start: str, *closing: str) -> Column:
    """The pieces from each place as ``cut_at`` finds it, each up to the first of these closing tags in it."""
    marked = F.regexp_replace(html, start, NEXT)
    return after_first(F.split(F.regexp_replace(marked, rf"(?i)</(?:{'|'.join(closing)})(?![a-z0-9-])[^<>]*+>[^{NEXT}]*+", ""), NEXT, -1))


def plain_texts(marked: Column | str) -> Column:
    """The text behind each ``NEXT`` without its tags, every run of it stripped; for markup without references."""
    bare = F.regexp_replace(marked, r"<[^<>]*+>\s*+|(?=<)", PART)
    return after_first(F.split(F.regexp_replace(bare, rf"(?<!\s)\s++(?=[{NEXT}{PART}]|\z)|{PART}", ""), NEXT, -1))


def piece_texts(piece: Column) -> Column:
    """The runs of text behind a piece's tag, cut at every further tag, as written."""
    return after_first(F.split(F.regexp_replace(piece, r"^[^<>]*>|<[^<>]*>|(?=<)", PART), PART, -1))
