"""Grouped reports (AGG-1..13, SRT-*, RPT-3..6, RPT-10).

Every rollup is one ``groupBy().agg()``: Spark runs a partial aggregate in
each input partition and a final one after the shuffle, so hot groups are
combined before they move.  First/last members are ``min``/``max`` of a
struct (time, tiebreak, label) -- no sort of the whole group, no window.
Lists are distinct values (``collect_set``, combined map-side) sorted after
aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions import arrays as A
from silverline.functions import predicates as P


def sorted_set(c: Column | str) -> Column:
    """AGG-7: distinct non-NULL values, sorted (byte order)."""
    return F.array_sort(F.collect_set(c))


def first_by(value: Column, order: Column, *tiebreak: Column, where: Column | None = None) -> Column:
    """AGG-6: value of the earliest row by ``order`` (ties -> smallest tiebreak)."""
    row = F.struct(order.alias("o"), *[t.alias(f"t{i}") for i, t in enumerate(tiebreak)], value.alias("v"))
    return F.min(row if where is None else F.when(where, row))["v"]


def last_by(value: Column, order: Column, *tiebreak: Column, where: Column | None = None) -> Column:
    """AGG-6: value of the latest row by ``order`` (ties -> largest tiebreak)."""
    row = F.struct(order.alias("o"), *[t.alias(f"t{i}") for i, t in enumerate(tiebreak)], value.alias("v"))
    return F.max(row if where is None else F.when(where, row))["v"]


def sum_or_zero(c: Column | str) -> Column:
    """AGG-4: sum where an all-NULL (or empty) group gives 0, not NULL."""
    return F.coalesce(F.sum(c), F.lit(0))


def entity_rollup(df: DataFrame, group: str, name: str, site: str, table: str, created: str,
                  reported_group: str, sums: dict[str, str], lists: dict[str, str]) -> DataFrame:
    """RPT-3: per group -- JSON lists of sites and tables, distinct member
    count, earliest/latest time and member label (``name @ site``), sums,
    reported spellings and further sorted distinct lists as JSON."""
    label = F.concat(F.col(name), F.lit(" @ "), F.col(site))
    t = F.col(created)
    aggs = [
        F.to_json(sorted_set(site)).alias("source_sites_json"),
        F.to_json(sorted_set(table)).alias("source_tables_json"),
        F.count_distinct(F.col(name)).alias("entity_count"),
        F.min(t).alias("earliest_created_at"),
        F.max(t).alias("latest_created_at"),
        # members without a time have no place in the order
        first_by(label, t, label, where=t.isNotNull()).alias("earliest_entity"),
        last_by(label, t, label, where=t.isNotNull()).alias("latest_entity"),
        *[sum_or_zero(src).alias(out) for out, src in sums.items()],
        sorted_set(reported_group).alias("_reported_aliases"),
        *[F.to_json(sorted_set(src)).alias(out) for out, src in lists.items()],
    ]
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(*aggs)


def device_rollup(df: DataFrame, group: str, member: str, kind_col: str, kind: str,
                  dates: dict[str, tuple[str, str]], reported_group: str) -> DataFrame:
    """RPT-4: rows of one kind (FLT-1 + FLT-2) per group -- distinct member
    count, min/max dates and the reported spellings."""
    f = df.filter(F.col(group).isNotNull() & (F.col(kind_col) == F.lit(kind)))
    aggs = [F.count_distinct(F.col(member)).alias("device_count")]
    for out, (fn, src) in dates.items():
        aggs.append((F.min(src) if fn == "min" else F.max(src)).alias(out))
    aggs.append(sorted_set(reported_group).alias("_reported_aliases_dev"))
    return f.groupBy(group).agg(*aggs)


def gold_join(entities: DataFrame, devices: DataFrame, group: str) -> DataFrame:
    """RPT-5: entity rollup LEFT JOIN device rollup (both keyed by ``group``
    by construction, so 1:1 holds), merged reported spellings as a sorted
    JSON list, every timestamp column as a DATE."""
    from silverline.operators.clean import datetimes_to_dates

    j = entities.join(devices, group, "left")
    j = j.withColumn("reported_aliases_json",
                     F.to_json(A.merge_sorted("_reported_aliases", "_reported_aliases_dev")))
    return datetimes_to_dates(j.drop("_reported_aliases", "_reported_aliases_dev"))


def summary_by_group(df: DataFrame, group: str, member: str, rank: str, value: str,
                     year: str, junk: list[str], more_than: int = 14, keep: int = 15,
                     json_head: int = 200, salt_buckets: int = 1024, value_divisor: float = 1.0) -> DataFrame:
    """RPT-6: per group -- sum, count, per-member mean (half-even), earliest
    year, two sort keys with junk groups (NULL or a ``junk`` value) forced to
    0 (SRT-6), a truncated member list (ARR-4) and a JSON list of the first
    ``json_head`` members (JSN-3), members ordered by ``rank``.

    Only the first ``max(keep, json_head)`` members of a group are ever
    needed, so they are found with an exact two-level top-k: rank inside
    (group, salt) buckets, keep the top ``n`` of each bucket, then rank those
    candidates per group.  A group of any size is spread over
    ``salt_buckets`` tasks and only ``n * salt_buckets`` candidates per group
    reach the second level -- no task ever holds a whole group.

    ``salt_buckets`` bounds the rows of one first-level task to about
    (rows of the largest group) / ``salt_buckets``; the second level sees at
    most ``n * salt_buckets`` candidates per group.  ``value_divisor`` lets
    exact integer sums (e.g. cents) come out in units.
    """
    from pyspark.sql import Window

    n = max(keep, json_head)
    # Exact totals: one partial+final aggregate.
    totals = df.groupBy(group).agg((sum_or_zero(value) / F.lit(value_divisor)).alias("value_total"),
                                   F.count(F.lit(1)).alias("member_count"),
                                   F.min(year).alias("earliest_year"))
    # Exact top-n members per group, two levels.
    order = [F.col(rank).desc_nulls_last(), F.col(member).asc_nulls_last()]
    # the salt varies by row, so equal rows of a hot group spread as well
    salted = df.select(group, member, rank, F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets)).alias("_salt"))
    lvl1 = salted.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order)))
    cand = lvl1.filter(F.col("_r") <= n)
    lvl2 = cand.withColumn("_r2", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    top = (lvl2.filter(F.col("_r2") <= n)
           .groupBy(group)
           .agg(F.sort_array(F.collect_list(F.struct("_r2", F.col(member).alias("m")))).alias("_top")))
    top = top.select(F.col(group).alias("_g"), F.transform("_top", lambda x: x["m"]).alias("_members"))
    # NULL is a group of its own (AGG-1), so the join is NULL-safe.
    j = totals.join(top, totals[group].eqNullSafe(top["_g"]), "left").drop("_g")
    junk_group = P.is_null_or_in(F.col(group), junk)
    per_member = F.bround(F.col("value_total") / F.col("member_count"), 0)
    return j.select(
        group, "value_total", "member_count", per_member.alias("value_per_member"), "earliest_year",
        F.when(junk_group, F.lit(0.0)).otherwise(F.col("value_total").cast("double")).alias("sort_order"),
        F.when(junk_group, F.lit(0.0)).otherwise(per_member).alias("sort_order_per_member"),
        A.truncated_join(F.slice("_members", 1, keep), keep=keep, more_than=more_than).alias("member_list"),
        F.to_json(F.slice("_members", 1, json_head)).alias("member_list_json"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG-9: frequency table, most frequent first, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc_nulls_first(col))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """SRT-5: ``orderBy(...).limit(k)`` -- planned as TakeOrderedAndProject
    (a per-partition top-k then one merge of k x partitions rows)."""
    return df.orderBy(*order).limit(k)
