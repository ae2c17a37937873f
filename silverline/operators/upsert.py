"""Change detection, keyed upsert and prune of table snapshots (JOIN-2,
JOIN-7, UPS-1..6).

Parquet has no MERGE, so a table is a sequence of immutable snapshots:
``next = upsert(current, incoming)`` is computed as a DataFrame and written
to a NEW path; the caller then points readers at it.  Everything is
declarative joins; ``as_of`` is a parameter, never the clock.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from silverline.operators.dedup import keep_last

AUDIT_COLUMNS = ("created_at", "updated_at")


def comparison_columns(new: DataFrame, current: DataFrame, exclude_float: bool = True,
                       ignore: tuple[str, ...] = AUDIT_COLUMNS) -> list[str]:
    """UPS-1: sorted columns shared by both frames, minus float columns of the
    current table (float noise must not count as a change) and audit columns."""
    cur_types = {f.name: f.dataType for f in current.schema.fields}
    shared = sorted(set(new.columns) & set(current.columns) - set(ignore))
    if exclude_float:
        shared = [c for c in shared if not isinstance(cur_types[c], (DoubleType, FloatType))]
    return shared


def changed_rows(new: DataFrame, current: DataFrame, exclude_float: bool = True,
                 ignore: tuple[str, ...] = AUDIT_COLUMNS) -> DataFrame:
    """JOIN-2 / UPS-1: rows of ``new`` with no NULL-safe equal row in
    ``current`` over the comparison columns (new or changed rows).

    A ``left_anti`` join on ``<=>`` predicates; Catalyst derives hash keys
    from them (``coalesce(c, default), isnull(c)``) so this is a shuffle
    join, not a nested loop.  ``subtract`` would also de-duplicate.
    """
    cols = comparison_columns(new, current, exclude_float, ignore)
    if not cols:
        return new
    cur = current.select(*[F.col(c).cast(new.schema[c].dataType).alias(f"_o_{c}") for c in cols])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols])
    return new.join(cur, cond, "left_anti")


def one_per_key(new: DataFrame, key: list[str], order: list[str] | None) -> DataFrame:
    """Incoming rows reduced to one per key: the last by ``order`` wins, as a
    store's row-by-row upsert would leave it; the other columns break ties.
    Rows that are wholly equal collapse without an order."""
    return keep_last(new, key, list(order or []))


def _aligned(current: DataFrame, new: DataFrame, key: list[str], exclude_float: bool, order: list[str] | None = None):
    """One full outer join of the current snapshot and the incoming rows on
    the key, with a per-row class.  Both sides are hash-partitioned on the
    key once; inserted / updated / unchanged / absent, the next snapshot and
    its pruned form all come from this single join (no anti join, no second
    shuffle).  The snapshot's keys are unique; a key that repeats in ``new``
    is reduced to its last row by ``order`` first."""
    new = one_per_key(new, key, order)
    cur = current
    if "created_at" not in cur.columns:
        cur = cur.withColumns({"created_at": F.lit(None).cast("timestamp_ntz"),
                               "updated_at": F.lit(None).cast("timestamp_ntz")})
    cmp_cols = [c for c in comparison_columns(new, cur, exclude_float) if c not in key]
    value_cols = [c for c in cur.columns if c not in key and c not in AUDIT_COLUMNS]
    new_only = [c for c in new.columns if c not in key and c not in cur.columns and c not in AUDIT_COLUMNS]
    u = new.select(*key, *[F.col(c).alias(f"_u_{c}") for c in new.columns if c not in key and c not in AUDIT_COLUMNS],
                   F.lit(True).alias("_u"))
    c = cur.select(*key, *[F.col(x).alias(f"_c_{x}") for x in value_cols + list(AUDIT_COLUMNS)],
                   F.lit(True).alias("_c"))
    j = c.join(u, key, "full_outer")
    same = reduce(lambda a, b: a & b,
                  [F.col(f"_u_{x}").eqNullSafe(F.col(f"_c_{x}").cast(new.schema[x].dataType)) for x in cmp_cols],
                  F.lit(True))
    cls = (F.when(F.col("_u").isNull(), F.lit("absent"))
           .when(F.col("_c").isNull(), F.lit("inserted"))
           .when(same, F.lit("unchanged"))
           .otherwise(F.lit("updated")))
    return j.withColumn("_class", cls), value_cols, new_only, [x for x in new.columns if x not in key]


def upsert(current: DataFrame, new: DataFrame, key: list[str], as_of,
           exclude_float: bool = True, prune_missing: bool = False, order: list[str] | None = None) -> DataFrame:
    """UPS-2: next snapshot, with one row per key.

    * key absent from ``current``: inserted, ``created_at = updated_at = as_of``;
    * key present and the row changed: every non-key column of ``new``
      overwrites, ``created_at`` is kept, ``updated_at = as_of``;
    * otherwise (unchanged, or not in ``new``): the current row as is.
    Table columns that ``new`` lacks keep their current value.  With
    ``prune_missing`` (UPS-4) rows whose key is not in ``new`` are dropped in
    the same pass.  Of several incoming rows with one key the last by
    ``order`` counts (``one_per_key``).
    """
    as_of_lit = F.lit(as_of).cast("timestamp_ntz")
    j, value_cols, new_only, new_cols = _aligned(current, new, key, exclude_float, order)
    if prune_missing:
        j = j.filter(F.col("_class") != "absent")
    take_new = F.col("_class").isin("inserted", "updated")
    out = [F.col(k) for k in key]
    for col in value_cols:
        if col in new_cols:
            out.append(F.when(take_new, F.col(f"_u_{col}")).otherwise(F.col(f"_c_{col}")).alias(col))
        else:
            out.append(F.col(f"_c_{col}").alias(col))
    for col in new_only:
        out.append(F.when(take_new, F.col(f"_u_{col}")).alias(col))
    out.append(F.coalesce(F.col("_c_created_at"), as_of_lit).alias("created_at"))
    out.append(F.when(take_new, as_of_lit).otherwise(F.col("_c_updated_at")).alias("updated_at"))
    return j.select(*out)


def prune(target: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """JOIN-7 / UPS-4 / SNK-6: drop target rows whose key left the new set
    (any number of key columns).  ``upsert(prune_missing=True)`` does the
    same inside the upsert's own join."""
    return target.join(new.select(*key).distinct(), key, "left_semi")


def change_summary(current: DataFrame, new: DataFrame, key: list[str],
                   exclude_float: bool = True, order: list[str] | None = None) -> DataFrame:
    """UPS-5: one row per class -- ``inserted``, ``updated``, ``unchanged``
    (rows of ``new``) and ``absent`` (current keys not in ``new``) -- with
    counts, from the same single join as ``upsert``.  Counted by class, so
    new rows do not distort "unchanged"."""
    j = _aligned(current, new, key, exclude_float, order)[0]
    return j.groupBy(F.col("_class").alias("change")).agg(F.count(F.lit(1)).alias("n_rows"))


def write_bucketed(df: DataFrame, table: str, path: str, key: list[str], buckets: int) -> None:
    """Write a snapshot as an external table bucketed and sorted by the key.
    The next ``upsert`` reads it with ``spark.table(table)`` and joins it
    WITHOUT shuffling it: only the incoming rows are hash-partitioned into
    the same buckets.  Each version gets its own table name and path (never
    overwrite a table that the plan reads)."""
    (df.write.bucketBy(buckets, *key).sortBy(*key).mode("overwrite")
     .option("path", path).saveAsTable(table))


def publish(current: DataFrame, new: DataFrame, key: list[str], as_of, out_path: str, **options) -> bool:
    """UPS-3: ``publish_counted``, whether anything was written."""
    return publish_counted(current, new, key, as_of, out_path, **options)[0]


def publish_counted(current: DataFrame, new: DataFrame, key: list[str], as_of, out_path: str,
                    contract=None, prune_missing: bool = False, exclude_float: bool = True,
                    bucketed: tuple[str, int] | None = None, order: list[str] | None = None) -> tuple[bool, dict[str, int]]:
    """UPS-3 / UPS-5: validate -> upsert -> optional prune -> write a new
    snapshot; whether it was written, and the change summary.  The change
    classes are counted first (one small aggregate over the same join); when
    nothing would change -- no inserted or updated row, and no absent key when
    pruning -- nothing is written.  ``bucketed=(table_name, buckets)`` writes
    the snapshot as a table bucketed by the key (see ``write_bucketed``).
    ``new`` is read for the count and for the write: hand in stored rows where
    they are dear to make."""
    if contract is not None:
        new = contract.validate(new)
    counts = {r.change: r.n_rows for r in change_summary(current, new, key, exclude_float, order).collect()}  # <= 4 rows
    if not (counts.get("inserted") or counts.get("updated") or (prune_missing and counts.get("absent"))):
        return False, counts
    nxt = upsert(current, new, key, as_of, exclude_float, prune_missing=prune_missing, order=order)
    if bucketed is not None:
        write_bucketed(nxt, bucketed[0], out_path, key, bucketed[1])
    else:
        nxt.write.mode("overwrite").parquet(out_path)
    return True, counts
