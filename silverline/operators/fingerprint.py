"""JOIN-2 by fingerprints: changed rows found without moving wide rows.

Each row is known by two 64-bit hashes of its comparison columns, in which a
null is no empty column.  Equal rows have equal fingerprints, so a row whose
fingerprint the other side lacks has changed: the two sides meet as distinct
pairs of numbers, 16 bytes a row whatever its texts hold, copies combined
before they move.  Rows with a hit are confirmed column by column against the
rows of that fingerprint, joined and sorted on the two numbers alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.operators.digest import row_hash
from silverline.operators.upsert import AUDIT_COLUMNS, comparison_columns
from silverline.session import stored

#: Names of the fingerprint's halves; a frame must not have columns of these names.
FINGERPRINT = ["_fingerprint_1", "_fingerprint_2"]


def fingerprinted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with the fingerprint of ``columns``."""
    return rows.withColumns({name: row_hash(columns, seed) for seed, name in enumerate(FINGERPRINT, 1)})


def misses(new: DataFrame, current: DataFrame) -> DataFrame:
    """The distinct fingerprints of ``new`` that ``current`` lacks."""
    return new.select(*FINGERPRINT).distinct().join(current.select(*FINGERPRINT).distinct(), FINGERPRINT, "left_anti")


def changed_rows(new: DataFrame, current: DataFrame, exclude_float: bool = True, ignore: tuple[str, ...] = AUDIT_COLUMNS,
                 confirm: bool = True) -> DataFrame:
    """The rows that ``upsert.changed_rows`` gives: those of ``new`` without a
    null-safe equal row in ``current`` over the comparison columns.  Copies in
    ``new`` all stay or all go.  ``confirm=False`` takes an equal fingerprint
    as an equal row, so nothing but fingerprints is joined; two different rows
    share one with a chance of 2^-128 each, and rows with arrays more often,
    as hashes pass over null elements."""
    cols = comparison_columns(new, current, exclude_float, ignore)
    if not cols:
        return new
    cur = fingerprinted(current.select(*[F.col(f"`{c}`").cast(new.schema[c].dataType).alias(c) for c in cols]), cols)
    rows = fingerprinted(new, cols)
    # two numbers a row: Spark sees from the files whether they can be broadcast
    missed = stored(misses(rows, cur), "missed-fingerprints")
    changed = rows.join(missed, FINGERPRINT, "left_semi")
    if confirm:
        # one row for each fingerprint, unless different rows share it
        held = cur.groupBy(*FINGERPRINT).agg(F.collect_set(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])).alias("_held"))
        held = held.withColumnsRenamed({name: f"_held{name}" for name in FINGERPRINT})

        def equal(row):
            same = F.lit(True)
            for i, c in enumerate(cols):
                same = same & row[f"c{i}"].eqNullSafe(F.col(f"`{c}`"))
            return same

        hit = [F.col(name) == F.col(f"_held{name}") for name in FINGERPRINT]
        doubtful = rows.join(missed, FINGERPRINT, "left_anti")
        changed = changed.unionByName(doubtful.join(held, [*hit, F.exists("_held", equal)], "left_anti"))
    return changed.drop(*FINGERPRINT)
