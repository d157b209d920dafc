"""Insert-only loads: the first record written under an id stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a batch with more distinct ids than this is described by spans of ids instead of the ids
NAMED_IDS = 1000
SPANS = 32
STRIPS = 4096

_ORDERED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def skipping_options(id_column: str) -> dict[str, str]:
    """Writer options that put a Bloom filter of the ids, no larger than they need, into every row group."""
    return {f"parquet.bloom.filter.enabled#{id_column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _spans(ids: DataFrame) -> list[tuple]:
    """At most ``SPANS`` spans that hold all ``ids``.

    Numbers and times are summed up by strips of equal width, and strips next to each other are joined
    until few spans are left, those with the narrowest gap first. Other ids are cut into ranges by number.
    """
    ends = (F.min("id").alias("low"), F.max("id").alias("high"))
    if not isinstance(ids.schema["id"].dataType, (T.IntegralType, T.DecimalType, T.TimestampType)):
        parts = ids.repartitionByRange(SPANS, "id").groupBy(F.spark_partition_id().alias("part"))
        return [(r.low, r.high) for r in parts.agg(*ends).collect()]
    number = F.col("id").cast("double")
    low, high = ids.agg(F.min(number), F.max(number)).first()
    if low is None:
        return []
    strip = F.coalesce(F.width_bucket(number, F.lit(low), F.lit(high), F.lit(STRIPS)), F.lit(0))
    spans = sorted((r.low, r.high) for r in ids.groupBy(strip.alias("strip")).agg(*ends).collect())
    gaps = sorted(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1], reverse=True)[: SPANS - 1]
    starts = [0, *sorted(gaps)]
    return [(spans[a][0], spans[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(spans)])]


def may_hold(batch: DataFrame, id_column: str) -> Column | None:
    """A condition that every row of a target with an id of ``batch`` meets, for its scan to skip by; None if there is none.

    Few ids are named one by one: row groups whose span or Bloom filter admits none of them are not read.
    Many are described by at most ``SPANS`` spans, parted at the widest gaps between them, which row groups
    are compared with. What reaches the driver is ``NAMED_IDS`` ids or ``STRIPS`` rows.
    """
    if not isinstance(batch.schema[id_column].dataType, _ORDERED):
        return None
    column = F.col(id_column)
    ids = batch.select(column.alias("id"))
    few = [r.id for r in ids.distinct().limit(NAMED_IDS + 1).collect()]
    named = [i for i in few if i is not None]
    if len(few) <= NAMED_IDS:
        found = column.isin(named) if named else F.lit(False)
        return found | column.isNull() if len(named) < len(few) else found
    found = column.isNull()
    for low, high in _spans(ids.where("id IS NOT NULL")):
        found |= column.between(low, high)
    return found


def unseen(batch: DataFrame, target: DataFrame, id_column: str) -> DataFrame:
    """Rows of ``batch`` whose id the target lacks; a null id equals a null id.

    The target is read where its files may hold an id of the batch, and its ids are first reduced to
    those the batch brings. A batch below the broadcast threshold makes that a filter on the target's
    scan; the target is not shuffled. Ids repeated inside the batch are all kept.
    """
    admitted = may_hold(batch, id_column)
    target = target if admitted is None else target.where(admitted)
    brought = batch.select(F.col(id_column).alias("_brought")).distinct()
    known = (
        target.select(F.col(id_column).alias("_known"))
        .join(brought, F.col("_known").eqNullSafe(F.col("_brought")), "left_semi")
        .distinct()
    )
    return batch.join(known, F.col(id_column).eqNullSafe(F.col("_known")), "left_anti")


def append_new(batch: DataFrame, table: str, id_column: str, path: str | None = None) -> int:
    """Create ``table`` from the batch, or append its unseen rows by column name.

    Returns the number of rows written, observed while they are written. Replaying a batch
    writes nothing. Files carry Bloom filters of their ids, so a later batch passes over most of them.
    """
    spark = batch.sparkSession
    rows = batch
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)  # another session may have written
        target = spark.table(table)
        rows = unseen(batch, target, id_column).select(*target.columns)
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("parquet").options(**skipping_options(id_column))
    if path:
        writer = writer.option("path", path)
    writer.mode("append").saveAsTable(table)
    return seen.get["rows"]
