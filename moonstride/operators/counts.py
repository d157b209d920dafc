"""Counts per day and category, kept as a table and brought up to date for the days that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("date_day", "activity_name", "is_sport_exercise")


def day_counts(fact: DataFrame) -> DataFrame:
    """Number of rows ``n`` per day, activity name and sport flag; nulls are values like any other."""
    return fact.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))


def refreshed_counts(stored: DataFrame, fact: DataFrame, changed: DataFrame) -> DataFrame:
    """``stored`` with the days of ``changed`` (``date_day``, repeats allowed) counted anew from ``fact``.

    Name every day on which rows came, went or were altered, the null day too. The fact is read between the
    first and the last of them only, which a table clustered by day turns into few files; without a changed
    day it is not read. Days that are left have the counts they had.
    """
    days = changed.select(F.col("date_day").cast("date").alias("_day")).distinct()
    first, last, undated = days.agg(F.min("_day"), F.max("_day"), F.count_if(F.col("_day").isNull()) > 0).first()
    if first is None and not undated:
        return stored.select(*KEYS, "n")
    within = F.lit(False) if first is None else F.col("date_day").between(F.lit(first), F.lit(last))
    if undated:
        within = within | F.col("date_day").isNull()
    same = F.col("date_day").eqNullSafe(F.col("_day"))
    fresh = day_counts(fact.where(within).join(days, same, "left_semi"))
    return stored.select(*KEYS, "n").join(days, same, "left_anti").union(fresh)
