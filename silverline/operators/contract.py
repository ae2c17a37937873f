"""Data contracts (DQ-1..12).

A ``Contract`` is a ``StructType`` plus rules.  ``check`` evaluates every
rule in ONE projection (plus one aggregate for key uniqueness) and attaches
``_failures: array<string>`` to each row.  Type errors are row failures, not
job aborts: values are converted with ``try_cast`` and a value that was
present but became NULL fails ``<col>|dtype``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverline.session import stored

FAILURES = "_failures"


class ContractError(ValueError):
    """Raised by ``validate`` / ``enforce_budget`` with per-rule counts."""

    def __init__(self, message: str, counts: dict[str, int]):
        super().__init__(message)
        self.counts = counts


@dataclass
class Contract:
    schema: StructType
    name: str = "table"
    primary_key: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    min_length: dict[str, int] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    enums: dict[str, list] = field(default_factory=dict)
    non_negative: list[str] = field(default_factory=list)
    rules: dict[str, object] = field(default_factory=dict)  # name -> Column or () -> Column
    # key columns compared through their SHA-256 digest in uniqueness checks
    # (long texts): only 32-byte digests are shuffled, not the values
    digest_keys: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    # -- row-level -----------------------------------------------------
    def _row_checks(self, raw: dict[str, Column], typed: dict[str, Column]) -> dict[str, Column]:
        """Each rule's label and the condition under which a row fails it."""
        checks: dict[str, Column] = {}
        for f in self.schema.fields:
            r, t = raw[f.name], typed[f.name]
            checks[f"{f.name}|dtype"] = r.isNotNull() & t.isNull()
            if not f.nullable:
                checks[f"{f.name}|nullability"] = r.isNull()
            if f.name in self.min_length:
                checks[f"{f.name}|min_length"] = F.char_length(t) < self.min_length[f.name]
            if f.name in self.max_length:
                checks[f"{f.name}|max_length"] = F.char_length(t) > self.max_length[f.name]
            if f.name in self.enums:
                checks[f"{f.name}|enum"] = t.isNotNull() & ~t.isin(*self.enums[f.name])
            if f.name in self.non_negative:
                checks[f"{f.name}|min"] = t < 0
        for rname, rule in self.rules.items():
            # A rule must be TRUE; NULL counts as a failure.  A rule may be a
            # zero-argument callable so contracts can be declared at import
            # time, before any session exists.
            expr = rule() if callable(rule) else rule
            checks[f"rule|{rname}"] = ~F.coalesce(expr, F.lit(False))
        return checks

    def _constraints(self) -> list[tuple[str, list[str]]]:
        return ([("primary_key", list(self.primary_key))] if self.primary_key else []) + [("unique|" + ",".join(k), list(k)) for k in self.unique]

    def labels(self) -> list[str]:
        """The labels of all rules, in the order of a row's failures."""
        columns = {c: F.col(c) for c in self.columns}
        return [*self._row_checks(columns, columns), *(label for label, _ in self._constraints())]

    def check(self, df: DataFrame) -> DataFrame:
        """Contract columns (typed, in order) plus ``_failures``.  Rules see
        the typed contract columns; other input columns are dropped."""
        missing = [c for c in self.columns if c not in df.columns]
        df = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
        raw_names = {c: f"_raw_{c}" for c in self.columns}
        staged = df.select(*[F.col(c).alias(raw_names[c]) for c in self.columns],
                           *[F.col(c).try_cast(f.dataType).alias(c)
                             for c, f in zip(self.columns, self.schema.fields)])
        raw = {c: F.col(raw_names[c]) for c in self.columns}
        typed = {c: F.col(c) for c in self.columns}
        checks = [F.when(failed, F.lit(label)) for label, failed in self._row_checks(raw, typed).items()]
        out = staged.withColumn(FAILURES, F.filter(F.array(*checks), lambda x: x.isNotNull()))
        if self._constraints():
            out = _flag_duplicates(out, self._constraints(), self.digest_keys)
        return out.select(*self.columns, FAILURES)

    # -- results ---------------------------------------------------------
    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """DQ-8: ``(good, failed)``; ``failed`` keeps ``_failures`` reasons.
        Both halves filter one checked frame; persist it (or write it) when
        both are consumed."""
        checked = self.check(df)
        good = checked.filter(F.size(FAILURES) == 0).drop(FAILURES)
        bad = checked.filter(F.size(FAILURES) > 0)
        return good, bad

    def failure_counts(self, df: DataFrame) -> DataFrame:
        """Rows ``(rule, n_failed)`` for every rule that failed at least once."""
        return (self.check(df).select(F.explode(FAILURES).alias("rule"))
                .groupBy("rule").agg(F.count(F.lit(1)).alias("n_failed")))

    def totals(self, checked: DataFrame) -> dict[str, int]:
        """Total rows, failed rows and failures per rule, in one action: the
        rows are exploded by reason, with one reason more for every row."""
        marks = F.concat(F.array(F.lit("__rows__")), F.when(F.size(FAILURES) > 0, F.array(F.lit("__failed_rows__"))).otherwise(F.array()),
                         F.col(FAILURES))
        per_rule = checked.select(F.explode(marks).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
        return {"__rows__": 0, "__failed_rows__": 0} | {r["rule"]: int(r["n"]) for r in per_rule.collect()}  # one row per rule

    def checked(self, df: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """DQ-9 / DQ-10: every row with its failures, written once to the
        shared folder, and the totals, observed while they are written: the
        input is evaluated once and nothing is read back for counting."""
        labels, seen = self.labels(), Observation()
        failed = [F.count_if(F.array_contains(FAILURES, label)).alias(f"rule{i}") for i, label in enumerate(labels)]
        rows = stored(self.check(df).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(FAILURES) > 0).alias("failed"), *failed), "checked")
        found = seen.get
        counts = {"__rows__": found["rows"], "__failed_rows__": found["failed"]}
        return rows, counts | {label: found[f"rule{i}"] for i, label in enumerate(labels) if found[f"rule{i}"]}

    def validate(self, df: DataFrame) -> DataFrame:
        """DQ-7: typed frame, or ``ContractError`` with counts per rule."""
        rows, counts = self.checked(df)
        if counts["__failed_rows__"]:
            raise ContractError(f"{self.name}: {counts['__failed_rows__']} of {counts['__rows__']} rows fail", counts)
        return rows.drop(FAILURES)

    def enforce_budget(self, df: DataFrame, max_failed_fraction: float = 0.0,
                       quarantine_path: str | None = None) -> tuple[DataFrame, dict[str, int]]:
        """DQ-9 / DQ-10 / SNK-3: split, optionally write the failed rows, and
        raise when more than ``max_failed_fraction`` of rows fail."""
        rows, counts = self.checked(df)
        if quarantine_path and counts["__failed_rows__"]:
            rows.filter(F.size(FAILURES) > 0).write.mode("overwrite").parquet(quarantine_path)
        if counts["__failed_rows__"] > counts["__rows__"] * max_failed_fraction:
            raise ContractError(
                f"{self.name}: {counts['__failed_rows__']} of {counts['__rows__']} rows fail "
                f"(budget {max_failed_fraction:.2%})", counts)
        return rows.filter(F.size(FAILURES) == 0).drop(FAILURES), counts


def _flag_duplicates(df: DataFrame, constraints: list[tuple[str, list[str]]], digest_keys=()) -> DataFrame:
    """DQ-4 / DQ-5 / AGG-12: append each constraint's label to the rows
    whose key occurs more than once.

    Each constraint counts its keys in a partial + final aggregate (a hot key
    is combined map-side) and joins the repeated ones back.  No size is
    counted beforehand: AQE broadcasts the repeated keys when their stage
    turned out small, else it shuffles and splits skewed partitions.
    Long-text key columns (``digest_keys``) are compared by SHA-256 digest,
    so only digests are aggregated and compared."""
    cols: list[str] = []
    for _, key in constraints:
        cols += [c for c in key if c not in cols]
    kname = {c: f"_k{i}" for i, c in enumerate(cols)}
    keyed = df.withColumns({kname[c]: (F.unhex(F.sha2(F.col(c).cast("string"), 256)) if c in digest_keys
                                       else F.col(c)) for c in cols})
    out = keyed
    for i, (label, key) in enumerate(constraints):
        names = [kname[c] for c in key]
        repeated = (keyed.select(*names).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") > 1).select(*names, F.lit(True).alias(f"_dup{i}")))
        out = out.join(repeated, names, "left")
        out = out.withColumn(FAILURES, F.when(F.col(f"_dup{i}"), F.array_append(F.col(FAILURES), F.lit(label)))
                             .otherwise(F.col(FAILURES))).drop(f"_dup{i}")
    return out.drop(*[kname[c] for c in cols])
