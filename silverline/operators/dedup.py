"""Keyed dedup (WIN-1, WIN-2, AGG-13).

Both variants are aggregates, not windows: ``max``/``min`` of a struct whose
leading fields are the ordering columns and whose remaining fields are every
other column.  That keeps a deterministic full tiebreak and, unlike
``row_number() over (partition by key)``, runs as a partial (map-side) plus a
final aggregate, so one key holding a third of all rows is combined inside
every input partition before the shuffle instead of landing in one task.

Struct ordering puts NULL before any value, which is the order of an
ascending sort with NULLs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str | Column], which: str) -> DataFrame:
    order_cols: list[Column] = []
    named: list[str] = []
    for i, o in enumerate(order):
        if isinstance(o, str) and o not in keys and o not in named:
            order_cols.append(F.col(o))  # carried once: it is both ordering key and payload
            named.append(o)
        else:
            order_cols.append((F.col(o) if isinstance(o, str) else o).alias(f"_o{i}"))
    rest = [c for c in df.columns if c not in keys and c not in named]
    payload = F.struct(*order_cols, *[F.col(c) for c in rest])
    agg = F.max(payload) if which == "last" else F.min(payload)
    out_cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(agg.alias("_best")).select(*keys, *[F.col("_best")[c].alias(c) for c in out_cols])


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """WIN-1: after an ascending sort on ``order`` (NULLs first), keep the
    LAST row of every key.  E.g. largest hash rate wins and NULL loses.
    Remaining columns break ties, so the result never depends on row order."""
    return _pick(df, keys, order, "last")


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """WIN-2: keep the FIRST row of every key in ``order`` (e.g. page,
    row index).  ``dropDuplicates`` would keep an arbitrary row."""
    return _pick(df, keys, order, "first")


def distinct_sorted(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """AGG-13 + SRT-3: distinct rows (of ``columns``), sorted by every column."""
    d = (df.select(*columns) if columns else df).distinct()
    return d.orderBy(*d.columns)
