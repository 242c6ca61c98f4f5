"""Calendar expressions: financial years, month labels, Monday weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Australia/Melbourne"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fin_year(d: Column | str) -> Column:
    """`2017-18` for July 2017 to June 2018."""
    d = _col(d)
    first = F.year(F.add_months(d, -6))
    return F.concat(first.cast("string"), F.lit("-"), F.lpad(((first + 1) % 100).cast("string"), 2, "0"))


def fin_quarter(d: Column | str) -> Column:
    """`2017-18 Q1` for July to September 2017, and so on."""
    d = _col(d)
    return F.concat(fin_year(d), F.lit(" Q"), F.quarter(F.add_months(d, -6)).cast("string"))


def year_month(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def month_label(d: Column | str) -> Column:
    """`October 2025`."""
    return F.date_format(_col(d), "MMMM yyyy")


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "month")


def week_start(d: Column | str) -> Column:
    """Monday of the week the date falls in."""
    return F.trunc(_col(d), "week")


def first_monday_from(d: Column | str) -> Column:
    """First Monday on or after the date."""
    return F.trunc(F.date_add(_col(d), 6), "week")


def is_half_year_quarter(c: Column | str) -> Column:
    """True for the quarter labels that carry an axis tick (Q1 and Q3)."""
    return _col(c).rlike("Q1|Q3")


def local_now(zone: str = LOCAL_ZONE) -> Column:
    """Current wall clock of the zone, to the second, without a zone.

    Folded once per query, so every row of a load carries the same stamp.
    """
    here = F.current_timestamp().cast("timestamp_ntz")
    there = F.convert_timezone(F.current_timezone(), F.lit(zone), here)
    return F.date_trunc("second", there).cast("timestamp_ntz")
