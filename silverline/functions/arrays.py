"""Array and JSON expressions (ARR-1..6, JSN-1..4, SET-6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.strings import ColumnOrName, _c


def empty_if_null(c: ColumnOrName, element_type: str = "string") -> Column:
    """ARR-5: NULL list -> empty list of the element type."""
    return F.coalesce(_c(c), F.array().cast(f"array<{element_type}>"))


def sorted_distinct(c: ColumnOrName) -> Column:
    """ARR-6: distinct then sorted (byte order of strings, NULLs first)."""
    return F.array_sort(F.array_distinct(_c(c)))


def merge_sorted(a: ColumnOrName, b: ColumnOrName, element_type: str = "string") -> Column:
    """SET-6: union of two lists, NULL list treated as empty, distinct, sorted."""
    return F.array_sort(F.array_union(empty_if_null(a, element_type), empty_if_null(b, element_type)))


def head(c: ColumnOrName, n: int) -> Column:
    """ARR-2."""
    return F.slice(_c(c), 1, n)


def truncated_join(c: ColumnOrName, keep: int = 15, more_than: int = 14, sep: str = "\n",
                   marker: str = "TRUNCATED", tail: str = "...") -> Column:
    """ARR-4: when the list has more than ``more_than`` members, show
    ``marker`` + the first ``keep`` members + ``tail``, one per line; else the
    members joined.  With the defaults a list of exactly 15 keeps every member
    yet still gets the marker, as in the reference."""
    col = _c(c)
    return (F.when(F.size(col) > more_than,
                   F.concat(F.lit(marker + sep), F.array_join(F.slice(col, 1, keep), sep), F.lit(sep + tail)))
            .otherwise(F.array_join(col, sep)))


def to_json_list(c: ColumnOrName, keep_null_fields: bool = True) -> Column:
    """JSN-1 / JSN-2 / JSN-3: list (of scalars or structs) -> compact JSON
    text.  Struct fields that are NULL are written as ``null``."""
    opts = {"ignoreNullFields": "false"} if keep_null_fields else {}
    return F.to_json(_c(c), opts)


def json_array_not_empty(c: ColumnOrName) -> Column:
    """JSN-4: JSON array text holds at least one element."""
    return F.json_array_length(_c(c)) > 0
