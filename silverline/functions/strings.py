"""String expressions (STR-1..19)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c: ColumnOrName) -> Column:
    """STR-1: every run of (Unicode) whitespace -> one blank, then strip.

    ``(?U)`` makes Java's ``\\s`` Unicode-aware, so non-breaking and other
    Unicode spaces collapse as well."""
    return F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def empty_to_null(c: ColumnOrName) -> Column:
    """STR-2: ``''`` -> NULL."""
    return F.nullif(_c(c), F.lit(""))


def clean_text(c: ColumnOrName) -> Column:
    """STR-3: STR-1 then STR-2, so a blank-only value becomes NULL."""
    return empty_to_null(collapse_whitespace(c))


def sentinel_to_null(c: ColumnOrName, sentinels: list[str]) -> Column:
    """STR-4: exact, case-sensitive sentinel values -> NULL."""
    col = _c(c)
    return F.when(~col.isin(*sentinels), col)


_LEADING_FLAGS = re.compile(r"^\(\?([a-zA-Z]+)\)")


def _shift_groups(repl: str, by: int) -> str:
    """Renumber ``$n`` / ``${n}`` group references of a Java replacement
    (one pass, so each reference moves exactly once; ``\\$`` is kept)."""
    def shift(m: re.Match) -> str:
        return "$" + str(int(m.group(1) or m.group(2)) + by)
    return re.sub(r"(?<!\\)\$(?:\{(\d+)\}|(\d+))", shift, repl)


def replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """STR-5: replace only the FIRST regex match (Spark's ``regexp_replace``
    replaces all).  The pattern is anchored behind a lazy prefix group, and the
    group references of the replacement shift by one."""
    flags = ""
    m = _LEADING_FLAGS.match(pattern)
    if m:
        flags, pattern = m.group(1), pattern[m.end():]
    anchored = f"(?s)^(.*?)(?{flags}:{pattern})" if flags else f"(?s)^(.*?)(?:{pattern})"
    return F.regexp_replace(_c(c), anchored, "$1" + _shift_groups(replacement, 1))


def replace_all(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """STR-6 / STR-8: replace every regex match; ``$1`` refers to groups."""
    return F.regexp_replace(_c(c), pattern, replacement)


def replace_literal(c: ColumnOrName, old: str, new: str) -> Column:
    """STR-7: literal replace-all (no regex metacharacters)."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def extract_group(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """STR-9: one capture group; no match -> NULL (Spark returns ``''``)."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def split_last(c: ColumnOrName, sep: str) -> Column:
    """STR-10: last part after splitting on a literal separator."""
    return F.substring_index(_c(c), sep, -1)


def concat_strict(*cols: ColumnOrName) -> Column:
    """STR-11: ``a + b`` string concatenation; any NULL part gives NULL.
    Strings are column names; wrap literals in ``F.lit``."""
    return F.concat(*[_c(c) for c in cols])


def template(fmt: str, *cols: ColumnOrName) -> Column:
    """STR-12: ``'https://x/{}/'``-style template; each ``{}`` takes the next
    column cast to string.  A NULL column gives NULL (``format_string`` would
    print ``null``)."""
    pieces = fmt.split("{}")
    if len(pieces) - 1 != len(cols):
        raise ValueError("template placeholders and columns differ in number")
    out: list[Column] = []
    for i, piece in enumerate(pieces):
        if piece:
            out.append(F.lit(piece))
        if i < len(cols):
            out.append(_c(cols[i]).cast("string"))
    return F.concat(*out)


def concat_sep(sep: str, *cols: ColumnOrName) -> Column:
    """STR-13: join with a separator, NULL if any part is NULL
    (``concat_ws`` would skip NULLs)."""
    out: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            out.append(F.lit(sep))
        out.append(_c(c).cast("string"))
    return F.concat(*out)


def match_key(c: ColumnOrName) -> Column:
    """STR-14: lowercase and drop everything but ASCII letters and digits."""
    return F.regexp_replace(F.lower(_c(c)), "[^A-Za-z0-9]", "")


def join_url(*parts: ColumnOrName) -> Column:
    """STR-15: join URL parts with '/', collapse repeated slashes, restore the
    scheme's double slash."""
    joined = concat_sep("/", *parts)
    collapsed = F.regexp_replace(joined, "/{2,}", "/")
    # after collapsing, a scheme is followed by exactly one slash
    return F.regexp_replace(collapsed, "^([A-Za-z][A-Za-z0-9+.-]*):/", "$1://")


def snake_case_name(name: str) -> str:
    """STR-16 on metadata (column names): runs of non-alphanumerics -> '_',
    strip '_' at both ends, lowercase."""
    return re.sub(r"[^a-zA-Z0-9]+", "_", name).strip("_").lower()


def snake_case(c: ColumnOrName) -> Column:
    """STR-16 as a column expression."""
    s = F.regexp_replace(_c(c), "[^a-zA-Z0-9]+", "_")
    return F.lower(F.regexp_replace(s, "^_+|_+$", ""))


def slugify(c: ColumnOrName) -> Column:
    """STR-17: blanks -> dashes."""
    return F.replace(_c(c), F.lit(" "), F.lit("-"))


def text_before(c: ColumnOrName, delim: str) -> Column:
    """STR-18: text before the first occurrence of a delimiter (all of it when
    the delimiter is absent)."""
    return F.substring_index(_c(c), delim, 1)


def rstrip_chars(c: ColumnOrName, chars: str) -> Column:
    """STR-19: strip a set of trailing characters."""
    return F.regexp_replace(_c(c), "[" + re.escape(chars) + "]+$", "")
