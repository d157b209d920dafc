"""Running numbers in time order, without a window over the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moonstride.functions.times import day_of
from moonstride.session import stage

# monotonically_increasing_id: partition above bit 33, row within the partition below
_ROW_BITS = 33


def _sort_keys(columns: tuple[str, ...]) -> list[Column]:
    return [F.asc_nulls_last(name) for name in columns]


def _range_sorted(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``df`` in global order, staged, with the place of each row as ``_part`` and ``_row``.

    Range partitions split on all of ``order``: a time stamp (or null) held by a third of
    the rows is still spread over tasks by the tie-breaking id. The result is staged
    before anything is counted, because range bounds are sampled and a second run of the
    same plan may cut elsewhere.
    """
    keys = _sort_keys(order)
    slot = F.col("_slot")
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright(slot, _ROW_BITS)
    return stage(placed, "ordered").select(
        *df.columns, part.alias("_part"), (slot - F.shiftleft(part, _ROW_BITS)).alias("_row")
    )


def _add_numbers(placed: DataFrame, group: Column, name: str, name_in_group: str) -> DataFrame:
    """Turn places into numbers, over all rows and within ``group``.

    ``group`` must not go back and forth in the sort order, so each group is a run of
    neighbouring rows, in one or several parts. The runs (at most one per part plus one per
    group) are counted and summed up; their table is small however large a group is.
    """
    placed = placed.withColumn("_group", group)
    runs = placed.groupBy("_part", "_group").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first_row")
    )
    earlier = Window.orderBy("_part", "_first_row").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    starts = stage(
        runs.select(
            F.col("_part").alias("_run_part"),
            F.col("_group").alias("_run_group"),
            (F.col("_before") - F.col("_first_row") + 1).alias("_offset"),
            F.min("_before").over(Window.partitionBy("_group")).alias("_before_group"),
        ),
        "run-starts",
    )
    same_run = (F.col("_part") == F.col("_run_part")) & F.col("_group").eqNullSafe(F.col("_run_group"))
    number = F.col("_offset") + F.col("_row")
    kept = [c for c in placed.columns if c not in ("_part", "_row", "_group")]
    return placed.join(starts, same_run).select(
        number.alias(name), (number - F.col("_before_group")).alias(name_in_group), *kept
    )


def _numbered(df: DataFrame, order: tuple[str, ...], group: Column, names: tuple[str, str]) -> DataFrame:
    """Number ``df`` through its sort keys alone, and join the numbers back.

    Only the keys are sorted and staged; the other columns are shuffled once, by the join,
    and only those a query uses. That needs keys without repeats. Where they repeat, the
    rows are staged with a row id, which then is the last sort key: copies of one key are
    spread over tasks as well.
    """
    rows, columns = df, df.columns
    placed = _range_sorted(df.groupBy(*order).agg(F.count(F.lit(1)).alias("_rows")), order)
    if not placed.where(F.col("_rows") > 1).isEmpty():
        rows = stage(df.withColumn("_copy", F.monotonically_increasing_id()), "copies")
        order = (*order, "_copy")
        placed = _range_sorted(rows.select(*order), order)
    numbers = _add_numbers(placed, group, *names)
    if set(columns) <= set(order):
        return numbers.select(*names, *columns)
    numbers = numbers.select(*names, *(F.col(c).alias(f"_key_{c}") for c in order))
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in order))
    return rows.join(numbers, on, "left").select(*names, *columns)


def number_rows(df: DataFrame, order: tuple[str, ...], name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... over all rows in ascending order, nulls last."""
    return _numbered(df, order, F.lit(0), (name, "_in_group")).drop("_in_group")


def number_by_time(df: DataFrame, moment: str, tie_breaker: str, name: str, name_of_day: str) -> DataFrame:
    """Add a running number over all rows and one that restarts every day.

    Both come from one sort on (moment, tie_breaker); a day with a third of all rows is
    never brought together. Rows without a moment come last and count as one day.
    """
    return _numbered(df, (moment, tie_breaker), day_of(F.col(moment)), (name, name_of_day))


def nth_of_day(df: DataFrame, moment: str, tie_breaker: str, n: int = 1) -> DataFrame:
    """The n-th row of every day, with its ``date_day``.

    Spark limits each group before the shuffle, so a task sends at most ``n`` rows per day.
    """
    in_day = Window.partitionBy("date_day").orderBy(*_sort_keys((moment, tie_breaker)))
    return (
        df.withColumn("date_day", day_of(F.col(moment)))
        .withColumn("_nth", F.row_number().over(in_day))
        .where(F.col("_nth") == n)
        .drop("_nth")
    )


def surrogate_keys(members: DataFrame, order: tuple[str, ...], name: str) -> DataFrame:
    """Number a distinct set 1, 2, 3, ... in ascending order, nulls last.

    Columns that ``order`` lacks are the last sort keys. Members are distinct, so they are placed and
    numbered as they are, whatever their number.
    """
    order = (*order, *(c for c in members.columns if c not in order))
    numbered = _add_numbers(_range_sorted(members, order), F.lit(0), name, "_in_group")
    return numbered.select(name, *members.columns)
