"""Row filters. Date filters are half-open ranges on the bare column, so they reach the scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(*names: str) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def _between(name: str, start: date, end: date) -> Column:
    return (F.col(name) >= F.lit(start)) & (F.col(name) < F.lit(end))


def first_of_next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def in_month_of_year(name: str, year: int, month: int) -> Column:
    start = date(year, month, 1)
    return _between(name, start, first_of_next_month(start))


def in_year(name: str, year: int) -> Column:
    return _between(name, date(year, 1, 1), date(year + 1, 1, 1))


def in_months(name: str, *months: int) -> Column:
    """These months of any year."""
    return F.month(name).isin(*months)


def in_last_days(name: str, days: int, as_of: date | None = None) -> Column:
    """From ``days`` days before ``as_of`` (today) on, with no upper bound."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.col(name) >= F.date_sub(today, days)


def in_this_month(name: str, as_of: date | None = None) -> Column:
    return _in_this(name, "MM", 1, as_of)


def in_this_year(name: str, as_of: date | None = None) -> Column:
    return _in_this(name, "YYYY", 12, as_of)


def _in_this(name: str, unit: str, months: int, as_of: date | None) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    start = F.trunc(today, unit)
    return (F.col(name) >= start) & (F.col(name) < F.add_months(start, months))


def on_date(name: str, day: date) -> Column:
    return F.col(name) == F.lit(day)
