"""Calendar dimension and what depends on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moonstride.functions.times import weekday_number

HORIZON_MONTHS = 48


def calendar_from(fact: DataFrame, day: str = "date_day", end: date | None = None) -> DataFrame:
    """One row per day from the first day of ``fact`` up to, not including, ``end``.

    Without ``end`` the calendar runs to four years from today.
    """
    stop = F.add_months(F.current_date(), HORIZON_MONTHS) if end is None else F.lit(end)
    bounds = fact.agg(F.min(F.col(day).cast("date")).alias("first_day"), stop.alias("stop"))
    spine = bounds.where(F.col("first_day") < F.col("stop")).select(
        F.explode(F.sequence("first_day", F.date_sub("stop", 1))).alias("date_day")
    )
    return describe_days(spine)


def describe_days(spine: DataFrame) -> DataFrame:
    """Attributes of every day of a spine. ``day_of_year`` counts the spine's days in the year."""
    day = F.col("date_day")
    number = weekday_number(day)
    in_year = Window.partitionBy("year").orderBy("date_day")
    return (
        spine.select(
            day,
            F.year(day).cast("long").alias("year"),
            F.month(day).cast("long").alias("month"),
            F.weekofyear(day).cast("long").alias("week"),
            F.dayofmonth(day).cast("long").alias("day"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "MMMM").alias("month_name"),
            number.alias("weekday_number"),
        )
        .withColumn("is_weekday", F.col("weekday_number").isin("1", "2", "3", "4", "5"))
        .withColumn("is_weekend", F.col("weekday_number").isin("0", "6"))
        .withColumn("day_of_year", F.row_number().over(in_year).cast("long"))
    )
