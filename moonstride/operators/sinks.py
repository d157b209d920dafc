"""Where results go."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moonstride.operators.layout import interleave


def schema_for(
    model: str,
    folder: str = "",
    explicit: str | None = None,
    sources: tuple[str, ...] = ("body", "track"),
    default: str = "main",
) -> str:
    """Schema a model belongs to; the first rule that fits wins."""
    if explicit is not None:
        return explicit.strip()
    model, folder = model.lower(), folder.lower()
    for source in sources:
        if source in model or source in folder:
            return source
    if "seed" in folder:
        return "seeds"
    if "date" in model or "dates" in folder:
        return "dates"
    if "semantic" in folder:
        return "semantic"
    return default


def rebuild_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
    cluster_by: tuple[str, ...] = (),
    ranges: int | None = None,
    interleave_by: tuple[str, ...] = (),
) -> DataFrame:
    """Replace a table by the query's result and return the table.

    With ``cluster_by`` the rows are range-partitioned and sorted by those columns, so that each file
    and row group spans few of their values and the reader passes over the others. Further columns
    after the first split a value that very many rows share. ``ranges`` fixes their number; without it
    adaptive execution merges ranges up to its advisory size, so a small table may be one file.
    ``interleave_by`` clusters by several columns alike: a filter on any of them passes over most files. Its
    cuts need one more reading of ``df``, so give it a written table.

    Rows of one table partition are brought together, so it gets few files; adaptive
    execution splits those that are too large for a task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif cluster_by:
        counted = [ranges] if ranges else []
        df = df.repartitionByRange(*counted, *cluster_by).sortWithinPartitions(*cluster_by)
    elif interleave_by:
        df = interleave(df, interleave_by, ranges)
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Name a query without running it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines, one part file per task."""
    df.write.json(path)


def write_snapshot(df: DataFrame, folder: str, prefix: str, taken_at: datetime, by_day: bool = False) -> str:
    """Records under a stamped name, as ``newest_snapshot`` finds them; returns the path."""
    stamp = taken_at.strftime("%Y-%m-%d" if by_day else "%Y%m%d_%H%M%S")
    path = f"{folder}/{prefix}_{stamp}.json"
    write_records(df, path)
    return path


def fetch_records(df: DataFrame, limit: int) -> list[dict]:
    """At most ``limit`` rows as dictionaries, for a caller outside Spark."""
    return [row.asDict(recursive=True) for row in df.limit(limit).collect()]


def as_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object with all its fields, nulls included."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    return df.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("record"))
