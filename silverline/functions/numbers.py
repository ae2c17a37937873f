"""Number expressions (MTH-1..8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.strings import ColumnOrName, _c

# Hash-rate units and their factor to "per second" (MTH-6).
# These must equal the reference's table for equal results.
HASHRATE_UNITS = {
    "H/s": 1.0,
    "kH/s": 1e3,
    "MH/s": 1e6,
    "GH/s": 1e9,
    "TH/s": 1e12,
    "PH/s": 1e15,
    "Sol/s": 1.0,
    "kSol/s": 1e3,
    "MSol/s": 1e6,
    "GSol/s": 1e9,
    "TSol/s": 1e12,
    "PSol/s": 1e15,
}

# Magnitude suffixes of money text (MTH-5).  Only "k" is
# matched case-insensitively; M, B and T are upper case only.
MAGNITUDE_SUFFIXES = {"k": 1e3, "K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}


def round_half_even(c: ColumnOrName, scale: int = 0) -> Column:
    """MTH-1 / MTH-3: banker's rounding (2.5 -> 2, 3.5 -> 4)."""
    return F.bround(_c(c), scale)


def round_to_int(c: ColumnOrName) -> Column:
    """MTH-1: half-even round, then integer; overflow -> NULL, not a job abort."""
    return F.bround(_c(c)).try_cast("bigint")


def truncate_to_int(c: ColumnOrName) -> Column:
    """MTH-2: drop the fraction (toward zero); overflow -> NULL."""
    return _c(c).try_cast("bigint")


def currency_to_int(c: ColumnOrName, strip: tuple[str, ...] = ("$", ",", " USD", "USD")) -> Column:
    """MTH-4: ``"$1,234.5"`` / ``"504,025,790.86 USD"`` -> 1234 / 504025791.

    The literal tokens are removed, the rest cast with ``try_cast`` (bad text
    -> NULL), then rounded half-even to a whole number."""
    s = _c(c)
    for tok in strip:
        s = F.replace(s, F.lit(tok), F.lit(""))
    return round_to_int(F.trim(s).try_cast("double"))


def magnitude_to_number(c: ColumnOrName) -> Column:
    """MTH-5: ``"$1.2M"`` -> 1.2e6.  ``$`` and blanks are dropped, a final
    k/K, M, B or T scales the number; other text (thousands commas included)
    gives NULL."""
    s = F.trim(F.replace(_c(c), F.lit("$"), F.lit("")))
    suffix = F.regexp_extract(s, r"([kKMBT])$", 1)
    number = F.trim(F.regexp_replace(s, r"[kKMBT]$", "")).try_cast("double")
    factor = F.coalesce(F.create_map(*[x for k, v in MAGNITUDE_SUFFIXES.items()
                                       for x in (F.lit(k), F.lit(v))])[suffix], F.lit(1.0))
    return number * factor


def unit_factor(unit: ColumnOrName, units: dict[str, float] | None = None) -> Column:
    """JOIN-6 over a literal map: unit text -> factor; unknown -> NULL."""
    units = units or HASHRATE_UNITS
    m = F.create_map(*[x for k, v in units.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(unit)]


def to_per_second(value: ColumnOrName, unit: ColumnOrName,
                  units: dict[str, float] | None = None) -> Column:
    """MTH-6: value x unit factor, rounded half-even to a whole number.  An
    unknown unit yields NULL; a contract rule can turn that into a failure."""
    return round_to_int(_c(value) * unit_factor(unit, units))


def unit_is_known(unit: ColumnOrName, units: dict[str, float] | None = None) -> Column:
    """Rule for JOIN-6 strictness: NULL unit passes, a non-NULL unknown fails."""
    u = _c(unit)
    return u.isNull() | u.isin(*(units or HASHRATE_UNITS).keys())


def least_non_null(*cols: ColumnOrName) -> Column:
    """MTH-7: horizontal minimum ignoring NULLs."""
    return F.least(*[_c(c) for c in cols])


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """MTH-8: division that yields NULL for a zero denominator."""
    return F.try_divide(_c(num), _c(den))
