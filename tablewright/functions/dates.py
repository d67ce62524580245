"""Date expressions: tolerant parsing, calendar parts and quarter arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_and_time(day: Column, clock: Column) -> Column:
    """``2011-04-27`` and ``16:30:00`` to one timestamp, NULL when unreadable."""
    return F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-MM-dd HH:mm:ss"))


def month_text(c: Column) -> Column:
    """``Jan 2001`` to the first of the month, NULL when unreadable."""
    return F.try_to_timestamp(c, F.lit("MMM yyyy")).cast("date")


def iso(c: Column) -> Column:
    return F.try_to_timestamp(c)


def quarter_text_start(c: Column) -> Column:
    """``2005Q3`` to 2005-07-01."""
    part = F.split(c, "Q")
    year, quarter = part[0].try_cast("int"), F.try_element_at(part, F.lit(2)).try_cast("int")
    return F.when(quarter.between(1, 4), F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1)))


# fixed values: quarter numerals
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4}


def roman_quarter(c: Column) -> Column:
    """``IV`` to 4; other text is NULL."""
    out = F.lit(None).cast("int")
    for numeral, number in ROMAN.items():
        out = F.when(c == numeral, F.lit(number)).otherwise(out)
    return out


def quarter_start(c: Column) -> Column:
    return F.trunc(c, "quarter")


def quarter_end(c: Column) -> Column:
    """Last day of the quarter that holds the date."""
    return F.last_day(F.add_months(F.trunc(c, "quarter"), 2))


def quarter_index(c: Column) -> Column:
    """A dense quarter number, so that time steps need no global window."""
    return F.year(c) * 4 + F.quarter(c) - 1


def quarter_from_index(i: Column) -> Column:
    """Start date of a dense quarter number."""
    return F.make_date(F.floor(i / 4).cast("int"), (F.pmod(i, F.lit(4)) * 3 + 1).cast("int"), F.lit(1))


def next_quarter(c: Column) -> Column:
    return F.add_months(F.trunc(c, "quarter"), 3)


def future_quarter_ends(last: Column, periods: int) -> Column:
    """Array of the next ``periods`` quarter ends after the quarter of ``last``."""
    first = next_quarter(last)
    starts = F.sequence(first, F.add_months(first, 3 * (periods - 1)), F.expr("interval 3 months"))
    return F.transform(starts, lambda d: F.last_day(F.add_months(d, 2)))


def weekday_monday0(c: Column) -> Column:
    return F.weekday(c)


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def iso_date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
