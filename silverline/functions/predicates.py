"""Predicates (FLT-1..13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.strings import ColumnOrName, _c


def is_null_or_in(c: ColumnOrName, values: list[str]) -> Column:
    """FLT-5: ``c IS NULL OR c IN (values)`` -- NULL is tested separately
    because ``'x' IN (NULL, ...)`` is NULL, not false."""
    col = _c(c)
    return col.isNull() | F.coalesce(col.isin(*[v for v in values if v is not None]), F.lit(False))


def eq_null_safe(a: ColumnOrName, b: ColumnOrName) -> Column:
    """FLT-7: NULL equals NULL."""
    return _c(a).eqNullSafe(_c(b))


def contains_flag(c: ColumnOrName, needle: str) -> Column:
    """FLT-8: literal substring test (NULL input -> false)."""
    return F.coalesce(_c(c).contains(needle), F.lit(False))


# The entity-page URL shape of FLT-9 (a coin path with an
# optional final slash) and the excluded AMP endings.
DIRECT_URL_PATTERN = r"^https://cryptoslate\.com/coins/[^/?=]+/?$"
AMP_SUFFIX_PATTERN = r"/amp/?$"


def is_direct_url(url: ColumnOrName, pattern: str = DIRECT_URL_PATTERN,
                  exclude_pattern: str = AMP_SUFFIX_PATTERN) -> Column:
    """FLT-9: URL matches ``pattern`` and does not end in ``/amp`` or
    ``/amp/``.  Java's ``$`` also matches before a final line break, so the
    URL must not contain one."""
    u = _c(url)
    return (~u.rlike(exclude_pattern)) & u.rlike(pattern) & ~u.rlike("[\\r\\n]")


def has_any_marker(text: ColumnOrName, markers: list[str]) -> Column:
    """FLT-10: at least one literal marker occurs."""
    col = _c(text)
    out = F.lit(False)
    for m in markers:
        out = out | col.contains(m)
    return out


def min_bytes(text: ColumnOrName, n: int) -> Column:
    """FLT-11: content of at least ``n`` bytes (UTF-8 bytes, not characters)."""
    return F.octet_length(_c(text)) >= n


def is_last_page(html: ColumnOrName, page: ColumnOrName,
                 marker: str = '<li class="page-item disabled') -> Column:
    """FLT-13: a page after the first whose pager shows a disabled item."""
    return (_c(page) > 1) & _c(html).contains(marker)
