"""The insert-only load as a stream over landing files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moonstride.operators.load import append_new
from moonstride.plans.loading import KINDS
from moonstride.plans.staging import flatten_activities
from moonstride.session import release, stage
from moonstride.sources.landing import FILE, WRITTEN, land, warn_unreadable


@dataclass(frozen=True)
class LandingStream:
    """Names of files as they land, and how to read their records."""

    names: DataFrame
    schema: str
    is_activity: bool = False


def stream_landing(
    spark: SparkSession, folder: str, schema: str, max_files_per_trigger: int = 1000, is_activity: bool = False
) -> LandingStream:
    """Files below ``folder`` as they land. The stream carries names; records are read as in a batch."""
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
    )
    return LandingStream(names, schema, is_activity)


def stream_kind(spark: SparkSession, folder: str, kind: str, max_files_per_trigger: int = 1000) -> LandingStream:
    """Files of one of the kinds that ``plans.loading`` knows."""
    rules = KINDS[kind]
    return stream_landing(spark, f"{folder}/{kind}_*.json", rules.layout, max_files_per_trigger, rules.is_activity)


def keep_first_file(batch: DataFrame, id_column: str) -> DataFrame:
    """Of several files with the same id, keep the rows of the earliest.

    A micro-batch then gives what loading its files one after the other would give.
    """
    arrival = F.struct(WRITTEN, FILE)
    first = batch.groupBy(F.col(id_column).alias("_id")).agg(F.min(arrival).alias("_first"))
    same = F.col(id_column).eqNullSafe(F.col("_id")) & (arrival == F.col("_first"))
    return batch.join(first, same, "left_semi").drop(WRITTEN, FILE)


def ingest_landing(
    landing: LandingStream, table: str, id_column: str, checkpoint: str, path: str | None = None
) -> StreamingQuery:
    """Append unseen ids from the files of ``landing`` to ``table`` until no file is left.

    Files are read by the code that reads a batch: a file that is not whole JSON adds nothing and is
    named in a warning. The target table is the state. A micro-batch that runs twice finds its ids
    there, so a restart after a failure, even from a new checkpoint, adds nothing twice.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        names = [r.path for r in batch.collect()]  # at most max_files_per_trigger
        if not names:
            return
        landed = land(spark, names, landing.schema, origin=True)
        warn_unreadable(landed.files)
        arrived = flatten_activities(landed.records) if landing.is_activity else landed.records
        if landed.parsed is None:
            append_new(keep_first_file(arrived, id_column), table, id_column, path)
        else:
            # the load reads its batch several times; rows are chosen once
            chosen = stage(keep_first_file(arrived, id_column), "arrived")
            append_new(chosen, table, id_column, path)
            release(chosen)
            release(landed.parsed)
        # batches run in a session of their own; the caller's must list the new files
        landing.names.sparkSession.catalog.refreshTable(table)

    return (
        landing.names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
