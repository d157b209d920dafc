"""Date and time expressions. All work on timestamps without zone and ignore the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(moment: Column) -> Column:
    return F.to_date(moment)


def night_date(onset: Column, nap: Column) -> Column:
    """The night a sleep belongs to: before noon it is the day before, unless it is a nap.

    An unknown nap flag keeps the calendar day.
    """
    day = day_of(onset)
    return F.when((F.hour(onset) < 12) & nap.eqNullSafe(False), F.date_sub(day, 1)).otherwise(day)


def _minute_index(moment: Column) -> Column:
    days = F.datediff(F.to_date(moment), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(moment) * 60 + F.minute(moment)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two moments (10:00:59 to 10:01:01 is 1), not elapsed minutes."""
    return _minute_index(end) - _minute_index(start)


def weekday_number(day: Column) -> Column:
    """Sunday is '0'; a string, as the calendar stores it."""
    return (F.dayofweek(day) - 1).cast("string")
