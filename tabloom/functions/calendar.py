"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English day names, Monday first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Months labelled short by the listed-months rule.
LISTED_SHORT_MONTHS = (4, 6, 9)


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(ts)


def month_of_year(ts: str | Column) -> Column:
    return F.month(ts)


def day_of_week(ts: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts)


def day_position(ts: str | Column) -> Column:
    """1 = Monday ... 7 = Sunday, for reports that start the week on Monday."""
    return F.weekday(ts) + F.lit(1)


def day_name(ts: str | Column) -> Column:
    """English day name, whatever the locale of the executors."""
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), day_position(ts))


def weekend_flag(ts: str | Column) -> Column:
    """1 on Saturday and Sunday, else 0; 0 for a missing timestamp."""
    return F.when(F.weekday(ts) >= 5, 1).otherwise(0)


def long_month_flag(ts: str | Column, *, exact: bool = False) -> Column:
    """1 for a month of 31 days, 0 for a shorter one.

    The default looks only at the listed short months, so February and November count as
    long and a missing timestamp becomes 1. ``exact`` asks the calendar instead and keeps
    missing values missing.
    """
    if exact:
        return (F.dayofmonth(F.last_day(ts)) == 31).cast("int")
    return F.when(F.month(ts).isin(*LISTED_SHORT_MONTHS), 0).otherwise(1)
