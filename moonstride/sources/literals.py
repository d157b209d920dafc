"""Small fixed tables written into the plan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, schema: str, rows: Iterable[Sequence]) -> DataFrame:
    """Rows as literals, so Catalyst knows their size and broadcasts them by itself."""
    fields = T.StructType.fromDDL(schema).fields
    records = [
        F.struct(*(F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(fields, row, strict=True)))
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*records)))
