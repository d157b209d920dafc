"""Unit conversions and fixed-point casts.

Conversions stay unrounded doubles; only ``as_decimal2`` rounds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_decimal2(value: Column) -> Column:
    """Double to decimal(10,2), rounding the scaled double (1.005 gives 1.00)."""
    return (F.round(value.cast("double") * 100) / 100).cast("decimal(10,2)")


def as_integer(value: Column) -> Column:
    """Double to int, rounding half to even instead of truncating."""
    return F.bround(value.cast("double")).cast("int")


def minutes_from_millis(millis: Column) -> Column:
    return millis.cast("double") / 60000


def minutes_from_seconds(seconds: Column) -> Column:
    return seconds.cast("double") / 60


def hours_from_seconds(seconds: Column) -> Column:
    return seconds.cast("double") / 3600


def hours_from_minutes(minutes: Column) -> Column:
    return minutes.cast("double") / 60


def kilometers(meters: Column) -> Column:
    return meters.cast("double") / 1000


def kilometers_per_hour(meters_per_second: Column) -> Column:
    return meters_per_second.cast("double") * 3.6


def minutes_to_hhmm(minutes: Column) -> Column:
    """``HH:MM``; the total is rounded before the split, so 479.6 is 08:00 and never 07:60."""
    total = F.round(minutes).cast("long")
    # format_string prints a null argument as text, so the guard keeps null results null
    return F.when(
        minutes.isNotNull(),
        F.format_string("%02d:%02d", F.floor(total / 60), F.pmod(total, F.lit(60))),
    )
