"""Laying a table out by several columns at once, so that a filter on any of them passes over files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# rows whose place among the others percentile_approx may misjudge: 1 in ACCURACY
ACCURACY = 1000


def _as_number(df: DataFrame, column: str) -> Column:
    """The column as a number of the same order; texts count by their first seven bytes."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        lead = F.rpad(F.substring(F.hex(F.encode(value, "utf-8")), 1, 14), 14, "0")
        return F.conv(lead, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.datediff(value, F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    return value.cast("bigint" if isinstance(kind, T.BooleanType) else "double")


def interleaved_key(df: DataFrame, columns: tuple[str, ...], bits: int = 4) -> Column:
    """A number whose order keeps rows together that are near each other in all ``columns``.

    Each column is cut into ``2 ** bits`` parts of about equally many rows, and the bits of the parts'
    numbers are taken in turn, highest first. The cuts come from one aggregate over ``df``; only they,
    ``2 ** bits - 1`` numbers per column, reach the driver. A value that very many rows share fills one
    part. Nulls go to the lowest part, as do all rows of a column that is null throughout.
    """
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    numbers = [_as_number(df, c) for c in columns]
    cuts = df.agg(*(F.percentile_approx(n, shares, ACCURACY).alias(f"c{i}") for i, n in enumerate(numbers))).first()
    parts = []
    for number, found in zip(numbers, cuts):
        above = [(number > F.lit(cut)).cast("bigint") for cut in found or []]
        parts.append(F.coalesce(reduce(Column.__add__, above, F.lit(0).cast("bigint")), F.lit(0).cast("bigint")))
    key = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for part in parts:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("bigint")))
    return key


def interleave(df: DataFrame, columns: tuple[str, ...], ranges: int | None = None, bits: int = 4) -> DataFrame:
    """``df`` range-partitioned and sorted by the interleaved key, then by the columns themselves.

    The columns follow the key in the partitioning, so equal keys can be cut. Without ``ranges`` adaptive
    execution merges small partitions.
    """
    key = "_place"
    while key in df.columns:
        key = f"_{key}"
    order = [key, *(f"`{c}`" for c in columns)]
    counted = [ranges] if ranges else []
    placed = df.withColumn(key, interleaved_key(df, columns, bits))
    return placed.repartitionByRange(*counted, *order).sortWithinPartitions(*order).drop(key)
