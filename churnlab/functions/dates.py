"""Calendar functions as Column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_STARTS = ("sunday", "monday")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c: Column | str) -> Column:
    """Timestamp (or date) -> date."""
    return F.to_date(_col(c))


def date_lit(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def month_start(c: Column | str) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(as_date(c), "month")


def week_start(c: Column | str, start: str = "sunday") -> Column:
    """First day of the week containing the date.

    'sunday' is the warehouse models' week; 'monday' the prototype's (ISO).
    """
    d = as_date(c)
    if start == "monday":
        return F.trunc(d, "week")
    if start == "sunday":
        return F.date_sub(d, F.dayofweek(d) - F.lit(1))
    raise ValueError(f"week start must be one of {WEEK_STARTS}, got {start!r}")


def add_days(c: Column | str, n: int | Column) -> Column:
    return F.date_add(as_date(c), n if isinstance(n, Column) else F.lit(n))


def add_days_ts(c: Column | str, n: int | Column) -> Column:
    """Timestamp plus a whole number of days (keeps the time of day)."""
    days = n if isinstance(n, Column) else F.lit(n)
    return _col(c) + F.make_dt_interval(days.cast("int"))


def day_diff(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later`` (int)."""
    return F.datediff(as_date(later), as_date(earlier))


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Month boundaries crossed from ``earlier`` to ``later``.

    Counts calendar boundaries, not elapsed months: Jan 31 -> Feb 1 is 1.
    """
    a, b = as_date(later), as_date(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def month_series(lo: Column, hi: Column) -> Column:
    """Array of month starts from ``lo`` to ``hi`` inclusive.

    Null when ``lo > hi`` or either end is null, so that ``explode`` yields no
    row - Spark's ``sequence`` would raise on reversed bounds.
    """
    lo_m, hi_m = month_start(lo), month_start(hi)
    return F.when(lo_m <= hi_m, F.sequence(lo_m, hi_m, F.expr("INTERVAL 1 MONTH")))


def quarter_series(lo: Column, hi: Column) -> Column:
    """Array of the starts of the quarters that the months ``lo`` to ``hi`` fall in;
    null like ``month_series``."""
    lo_q, hi_q = F.trunc(lo, "quarter"), F.trunc(hi, "quarter")
    return F.when(lo <= hi, F.sequence(lo_q, hi_q, F.expr("INTERVAL 3 MONTHS")))
