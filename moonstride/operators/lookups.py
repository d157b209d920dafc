"""Joins of facts with lookups and dimensions.

No join carries a broadcast hint. Lookups are literals, files or staged tables, so Catalyst
knows their size: below ``spark.sql.autoBroadcastJoinThreshold`` the fact is not shuffled,
above it the join shuffles and adaptive execution splits skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_lookup(fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str) -> DataFrame:
    """All fact rows with the lookup's other columns; unmatched rows keep nulls."""
    other = [F.col(f"_lookup.{c}") for c in lookup.columns if c != lookup_key]
    on = F.col(f"_fact.{fact_key}") == F.col(f"_lookup.{lookup_key}")
    return fact.alias("_fact").join(lookup.alias("_lookup"), on, "left").select("_fact.*", *other)


def foreign_key(
    fact: DataFrame, dimension: DataFrame, keys: tuple[str, ...], name: str, null_safe: bool = False
) -> DataFrame:
    """Add the dimension's surrogate key ``name``, found over one or more natural keys.

    Plain equality gives a null key as soon as one natural key is null; ``null_safe``
    matches null with the null member.
    """

    def same(key: str) -> Column:
        left, right = F.col(f"_fact.{key}"), F.col(f"_dim.{key}")
        return left.eqNullSafe(right) if null_safe else left == right

    on = reduce(lambda a, b: a & b, (same(key) for key in keys))
    return fact.alias("_fact").join(dimension.alias("_dim"), on, "left").select("_fact.*", f"_dim.{name}")


def distinct_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """The non-null values of a key, each once; repeats are merged before the shuffle."""
    return df.select(F.col(key).alias(name)).where(F.col(name).isNotNull()).distinct()


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` that have no partner; a hot key on the right is merged first."""
    known = distinct_keys(right, right_key, "_known")
    return left.join(known, F.col(left_key) == F.col("_known"), "left_anti")


def existence_flags(left: DataFrame, key: str, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Add one boolean per source: does any of its rows carry this key? Rows never multiply.

    ``sources`` maps the flag's name to (frame, key column).
    """
    for flag, (frame, frame_key) in sources.items():
        seen = distinct_keys(frame, frame_key, "_seen")
        left = (
            left.join(seen, F.col(key) == F.col("_seen"), "left")
            .withColumn(flag, F.col("_seen").isNotNull())
            .drop("_seen")
        )
    return left


def rejoin(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Bring two facts of the same grain together again on their unique id."""
    extra = [c for c in right.columns if c == key or c not in left.columns]
    return left.join(right.select(*extra), key)
