"""Data-quality checks.

Each check returns the violating rows. ``run_suite`` counts violations instead: all row
checks of a table share one scan, and only counts leave it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared check. ``argument`` is a bound, the accepted values, or a parent column.

    ``parent`` may be a name until the check is run.
    """

    kind: str
    column: str
    argument: Any = None
    severity: str = "error"
    parent: DataFrame | str | None = field(default=None, compare=False)

    def warn_only(self) -> Check:
        return replace(self, severity="warn")


def violation(check: Check) -> Column:
    """Condition of a row check; a null passes all but ``not_null``."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "at_least":
        return value < F.lit(check.argument)
    if check.kind == "at_most":
        return value > F.lit(check.argument)
    if check.kind == "accepted_values":
        return ~value.isin(*check.argument)
    raise ValueError(f"{check.kind} is not a row check")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(violation(Check("not_null", column)))


def at_least(df: DataFrame, column: str, bound: Any) -> DataFrame:
    return df.where(violation(Check("at_least", column, bound)))


def at_most(df: DataFrame, column: str, bound: Any) -> DataFrame:
    return df.where(violation(Check("at_most", column, bound)))


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(violation(Check("accepted_values", column, tuple(values))))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, with their number; a null in a key passes."""
    present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    counted = df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent and how many rows hold each; a null value passes.

    Rows are counted per value before the join, so a hot value is one row in it.
    """
    children = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("child_rows"))
    parents = parent.select(F.col(parent_column).alias("_parent")).where(F.col("_parent").isNotNull())
    return children.join(parents, F.col(column) == F.col("_parent"), "left_anti")


def calendar_horizon(
    calendar: DataFrame, as_of: date | None = None, day: str = "date_day", warn_days: int = 3
) -> DataFrame:
    """One row if the calendar is empty or has run out (error) or will within ``warn_days`` (warn)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    end = F.col("end_date")
    severity = F.when(end.isNull() | (today >= end), "error").when(today >= F.date_sub(end, warn_days), "warn")
    return (
        calendar.agg(F.date_add(F.max(day), 1).alias("end_date"))
        .withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
    )


def _result_row(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(violations.cast("long"), F.lit(0).cast("long")).alias("violations"),
    )


def run_suite(df: DataFrame, table: str, checks: Iterable[Check]) -> DataFrame:
    """One row per check: table, column, check, severity and the number of violations.

    ``unique`` counts repeated values, the others count rows.
    """
    checks = list(checks)
    by_row = [c for c in checks if c.kind not in ("unique", "relationships")]
    parts = []
    if by_row:
        counts = [_result_row(c, F.count_if(violation(c))) for c in by_row]
        parts.append(df.agg(F.array(*counts).alias("results")))
    for c in checks:
        if c.kind == "unique":
            bad = unique(df, *c.column.split(", "))
            parts.append(bad.agg(F.array(_result_row(c, F.count(F.lit(1)))).alias("results")))
        elif c.kind == "relationships":
            bad = relationships(df, c.column, c.parent, c.argument)
            parts.append(bad.agg(F.array(_result_row(c, F.sum("child_rows"))).alias("results")))
    results = reduce(DataFrame.union, parts).select(F.inline("results"))
    return results.select(F.lit(table).alias("table_name"), "*")
