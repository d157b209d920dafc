"""On which days does a source hold data? Kept as bitmaps that grow with every load.

A source's days are bits, some 32,000 days to a bitmap of 4 KB. A load's bitmaps are made by one
aggregate with a partial step per task, so a day with very many rows costs one bit per task. Bitmaps
are merged by OR: loading twice, late or out of order gives the same bits. Flags are read off the
bits, without looking at the sources again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "source string, bucket bigint, days binary"


def _number(day: str) -> Column:
    return F.datediff(F.col(day).cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")


def day_bitmaps(source: DataFrame, name: str, day: str = "date_day") -> DataFrame:
    """``source`` (its name), ``bucket`` and ``days`` of the rows given; null days count for nothing."""
    days = source.select(_number(day).alias("_n")).where(F.col("_n").isNotNull())
    of_bucket = days.groupBy(F.bitmap_bucket_number("_n").alias("bucket"))
    made = of_bucket.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("days"))
    return made.select(F.lit(name).alias("source"), "bucket", "days")


def merged(*bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several loads or sources as one table, one row per source and bucket."""
    every = reduce(DataFrame.union, (b.select("source", "bucket", "days") for b in bitmaps))
    return every.groupBy("source", "bucket").agg(F.bitmap_or_agg("days").alias("days"))


def days_held(bitmaps: DataFrame) -> DataFrame:
    """Number of different days per source; a source without days is not there."""
    return bitmaps.groupBy("source").agg(F.sum(F.bitmap_count("days")).alias("days"))


def _is_set(days: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(days, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def availability_flags(left: DataFrame, bitmaps: DataFrame, flags: dict[str, str], day: str = "date_day") -> DataFrame:
    """Add one boolean per flag (flag: name of its source). Rows never multiply; a null day has no data.

    ``bitmaps`` has one row per source and bucket, as ``merged`` gives it; the join is on the bucket.
    """
    held = [F.max(F.when(F.col("source") == source, F.col("days"))).alias(f"_days{i}") for i, source in enumerate(flags.values())]
    by_bucket = bitmaps.groupBy(F.col("bucket").alias("_bucket")).agg(*held)
    number = _number(day)
    joined = left.join(by_bucket, F.bitmap_bucket_number(number) == F.col("_bucket"), "left")
    place = F.bitmap_bit_position(number)
    made = {flag: _is_set(F.col(f"_days{i}"), place) for i, flag in enumerate(flags)}
    return joined.withColumns(made).select(*(f"`{c}`" for c in left.columns), *flags)
