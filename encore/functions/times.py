"""Date expressions: month spans, periods, seasons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: period names and the days they cover
PERIOD_DAYS = {"last_week": 7, "last_month": 30, "last_quarter": 90, "last_year": 365, "last_2_years": 730}
# fixed values: grouping periods of the revenue report
REPORT_PERIODS = ("day", "week", "month", "quarter", "year")


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def moment(value: str | dt.date) -> Column:
    """Midnight of a date as a zone-less timestamp literal, so that comparisons reach the scan."""
    return F.lit(dt.datetime.combine(as_date(value), dt.time())).cast("timestamp_ntz")


def days_before(as_of: str | dt.date, days: int) -> dt.date:
    return as_date(as_of) - dt.timedelta(days=days)


def months_before(as_of: str | dt.date, months: int) -> dt.date:
    """Calendar months back, with the day cut to the length of the month."""
    day = as_date(as_of)
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    for last in (day.day, 30, 29, 28):
        try:
            return dt.date(year, month + 1, last)
        except ValueError:
            continue
    raise ValueError(as_of)


def month_span(first: Column, last: Column) -> Column:
    """Number of month boundaries between two dates (not ``months_between``)."""
    return (F.year(last) * 12 + F.month(last)) - (F.year(first) * 12 + F.month(first))


def period_start(period: str, when: Column) -> Column:
    return F.date_trunc(period, when).cast("date")


def period_end(period: str, start: Column) -> Column:
    if period == "day":
        return start
    if period == "week":
        return F.date_add(start, 6)
    months = {"month": 1, "quarter": 3, "year": 12}[period]
    return F.date_add(F.add_months(start, months), -1)


def is_weekend(when: Column) -> Column:
    return F.weekday(when) >= 5


def season(when: Column) -> Column:
    """1 for December to February, 2 for March to May, 3 for June to August, 4 for the rest."""
    return (F.floor(F.pmod(F.month(when), F.lit(12)) / 3) + 1).cast("int")
