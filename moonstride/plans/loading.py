"""From landing folder to raw tables, one kind of record at a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from moonstride.operators.load import append_new
from moonstride.plans.staging import flatten_activities
from moonstride.session import release
from moonstride.sources import schemas
from moonstride.sources.landing import (
    DAY_STAMP,
    SECOND_STAMP,
    land,
    newest_snapshot,
    warn_unreadable,
)


@dataclass(frozen=True)
class Kind:
    """How one kind of record lands: file stamp, layout, and the id that is loaded once."""

    layout: str
    id_column: str
    stamp: tuple[str, str] = DAY_STAMP
    is_activity: bool = False


KINDS = {
    "activities": Kind(schemas.ACTIVITY, "activity_id", SECOND_STAMP, is_activity=True),
    "workouts": Kind(schemas.WORKOUT, "id"),
    "sleeps": Kind(schemas.SLEEP, "id"),
    "cycles": Kind(schemas.CYCLE, "id"),
    "recoveries": Kind(schemas.RECOVERY, "cycle_id"),
}


def load_newest(spark: SparkSession, folder: str, kind: str, table: str, path: str | None = None) -> int:
    """Load the newest snapshot of a kind into its raw table; returns the rows added.

    Known ids stay as they are. Without a snapshot nothing happens. Files that are not whole JSON add
    nothing and are named in a warning.
    """
    rules = KINDS[kind]
    snapshot = newest_snapshot(spark, folder, kind, rules.stamp)
    if snapshot is None:
        return 0
    landed = land(spark, snapshot, rules.layout)
    warn_unreadable(landed.files)
    if not any(file.sound for file in landed.files):
        return 0
    records = flatten_activities(landed.records) if rules.is_activity else landed.records
    added = append_new(records, table, rules.id_column, path)
    release(landed.parsed)
    return added
