"""Aggregates and ordered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moonstride.functions.measures import hours_from_minutes, minutes_to_hhmm


def count_where(df: DataFrame, condition: Column | None = None, name: str = "count") -> DataFrame:
    """One row with the number of rows; 0 if none match."""
    rows = df if condition is None else df.where(condition)
    return rows.agg(F.count(F.lit(1)).alias(name))


def count_per(df: DataFrame, key: str, name: str = "activity_count") -> DataFrame:
    """Rows per key, ordered by key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.asc_nulls_last(key))


def latest(df: DataFrame, day: str, tie_breaker: str, n: int) -> DataFrame:
    """The ``n`` newest rows; each task keeps only its own ``n``."""
    return df.orderBy(F.desc_nulls_last(day), F.desc_nulls_last(tie_breaker)).limit(n)


def members(df: DataFrame, *names: str) -> DataFrame:
    """Distinct combinations; null is a member like any other."""
    return df.select(*names).distinct()


def summary_per_category(df: DataFrame, category: str, minutes: dict[str, str]) -> DataFrame:
    """Rows and mean minutes per category (trimmed, case-folded), also in hours and as HH:MM.

    ``minutes`` maps a short name to the column of minutes. Nulls do not count in a mean.
    """
    means = {f"{short}_minutes": F.avg(column) for short, column in minutes.items()}
    grouped = (
        df.where(F.col(category).isNotNull())
        .groupBy(F.lower(F.trim(category)).alias("category"))
        .agg(F.count(F.lit(1)).alias("nights"), *(m.alias(n) for n, m in means.items()))
    )
    return grouped.select(
        "*",
        *(hours_from_minutes(F.col(f"{s}_minutes")).alias(f"{s}_hours") for s in minutes),
        *(minutes_to_hhmm(F.col(f"{s}_minutes")).alias(f"{s}_hhmm") for s in minutes),
    )


def in_spine_order(summary: DataFrame, spine: DataFrame, category: str = "category") -> DataFrame:
    """Bring a summary into the order of a named spine (``category``, ``ordinal``).

    Spine entries without rows do not appear.
    """
    names = spine.select(F.lower(F.trim(category)).alias("_key"), F.col(category).alias("label"), "ordinal")
    return (
        summary.join(names, F.col(category) == F.col("_key")).drop("_key", category).orderBy("ordinal")
    )
