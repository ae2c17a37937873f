"""Stacking sources into one schema (PRJ-1, PRJ-9, PRJ-10, SET-1..4)."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class SourceSpec:
    """One source of a stack: the frame, literal tags and a mapping
    ``target column -> Column`` evaluated against the frame."""

    df: DataFrame
    mapping: dict[str, Column | str]
    tags: dict[str, object] = field(default_factory=dict)

    def project(self, schema: StructType) -> DataFrame:
        cols: list[Column] = []
        for f in schema.fields:
            if f.name in self.tags:
                expr = F.lit(self.tags[f.name])
            elif f.name in self.mapping:
                m = self.mapping[f.name]
                expr = F.col(m) if isinstance(m, str) else m
            else:
                expr = F.lit(None)
            # try_cast: a part whose value does not fit becomes NULL (and a
            # contract rule reports it) instead of failing the whole stack.
            cols.append(expr.try_cast(f.dataType).alias(f.name))
        unknown = set(self.mapping) - {f.name for f in schema.fields}
        if unknown:
            raise KeyError(f"mapping names columns not in the target schema: {sorted(unknown)}")
        return self.df.select(cols)


def stack(parts: list[SourceSpec], schema: StructType) -> DataFrame:
    """SET-1 / SET-2: project every part to ``schema`` (types pinned per
    part, so ``unionByName`` never widens silently), then union.  A union is
    narrow: no shuffle."""
    if not parts:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b), [p.project(schema) for p in parts])


def tag(df: DataFrame, **tags) -> DataFrame:
    """SET-3 helper: add literal tag columns."""
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def union_tagged(frames: dict[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """SET-3: stack frames of one schema, each tagged with its name."""
    tagged = [tag(df, **{tag_col: name}) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
