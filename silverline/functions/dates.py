"""Date expressions (DAT-1..9).  ``as_of`` values are parameters: nothing here
reads the clock, so a query gives the same answer on every run."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.strings import ColumnOrName, _c


def parse_date(c: ColumnOrName, fmt: str = "MMM d, yyyy") -> Column:
    """DAT-1: formatted text -> DATE; text that does not parse -> NULL.
    (Spark pattern letters: ``MMM d, yyyy`` reads ``Jan 03, 2009``.)"""
    return F.try_to_date(_c(c), fmt)


def iso_to_date(c: ColumnOrName) -> Column:
    """DAT-2 / DAT-3: ISO text or timestamp -> DATE (NULL when malformed)."""
    return _c(c).try_cast("timestamp_ntz").cast("date")


def year_start(year: ColumnOrName) -> Column:
    """DAT-4: year -> Jan 1 of that year; NULL year -> NULL."""
    return F.make_date(_c(year).try_cast("int"), F.lit(1), F.lit(1))


def year_of(c: ColumnOrName) -> Column:
    """DAT-5."""
    return F.year(_c(c))


def first_non_null(*cols: ColumnOrName) -> Column:
    """DAT-6."""
    return F.coalesce(*[_c(c) for c in cols])


def _year(as_of: _dt.date | str | None) -> int:
    if as_of is None:
        raise ValueError("as_of is required: queries must not read the clock")
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of[:10])
    return as_of.year


def earliest_year_mention(text: ColumnOrName, as_of: _dt.date | str,
                          pattern: str = r"(?i)in (20\d{2})", min_year: int = 2000) -> Column:
    """DAT-7: smallest plausible year among all ``in 20xx`` mentions of the
    whole text (years from ``min_year`` to the ``as_of`` year); none -> NULL."""
    hi = _year(as_of)
    years = F.transform(F.regexp_extract_all(_c(text), F.lit(pattern), 1), lambda y: y.cast("int"))
    return F.array_min(F.filter(years, lambda y: (y >= min_year) & (y <= hi)))


# Class names of the logo container in the two page layouts,
# and the shape of an uploaded logo asset URL (DAT-8).
LOGO_CONTAINER_CLASSES = ("name-logo", "logo-container", "coin-page-hero__logo")
LOGO_ASSET_PATTERN = r"(?i)/wp-content/uploads/(\d{4}/\d{2})/[A-Za-z0-9\-_]+-logo\.(?:jpg|png|jpeg)"


def logo_scope(html: ColumnOrName, classes: tuple[str, ...] = LOGO_CONTAINER_CLASSES) -> Column:
    """Inner text of the first ``<div>`` whose class list holds one of
    ``classes`` (tried in order), up to its own closing tag: nested divs belong
    to it.  Empty when there is none."""
    from silverline.operators.extract import scope

    return F.coalesce(*[scope(html, "div", c) for c in classes], F.lit(""))


def earliest_upload_date(text: ColumnOrName, as_of: _dt.date | str,
                         pattern: str = LOGO_ASSET_PATTERN, min_year: int = 2000) -> Column:
    """DAT-8: earliest ``YYYY/MM`` of asset URLs -> first day of that month.
    Months outside 1..12 and years outside ``min_year``..as_of are ignored."""
    hi = _year(as_of)
    ym = F.regexp_extract_all(_c(text), F.lit(pattern), 1)
    ok = F.filter(ym, lambda s: (F.substring(s, 1, 4).cast("int").between(min_year, hi))
                  & (F.substring(s, 6, 2).cast("int").between(1, 12)))
    dates = F.transform(ok, lambda s: F.make_date(F.substring(s, 1, 4).cast("int"),
                                                  F.substring(s, 6, 2).cast("int"), F.lit(1)))
    return F.array_min(dates)


def humanised_age(c: ColumnOrName, as_of: _dt.date | str) -> Column:
    """DAT-9: age of a date relative to ``as_of`` as words.

    Our own wording: ``unknown`` (NULL), ``in the future``, ``today``,
    ``yesterday``, ``N days ago`` (< 30), ``a month ago`` / ``N months ago``
    (30-day months, < 365 days), ``a year ago`` / ``N years ago`` (365-day years).
    """
    as_of_date = F.lit(str(as_of)[:10]).cast("date")
    d = F.datediff(as_of_date, _c(c).cast("date"))
    months = F.floor(d / 30).cast("bigint")
    years = F.floor(d / 365).cast("bigint")
    return (F.when(d.isNull(), F.lit("unknown"))
            .when(d < 0, F.lit("in the future"))
            .when(d == 0, F.lit("today"))
            .when(d == 1, F.lit("yesterday"))
            .when(d < 30, F.concat(d.cast("string"), F.lit(" days ago")))
            .when(d < 60, F.lit("a month ago"))
            .when(d < 365, F.concat(months.cast("string"), F.lit(" months ago")))
            .when(d < 730, F.lit("a year ago"))
            .otherwise(F.concat(years.cast("string"), F.lit(" years ago"))))
