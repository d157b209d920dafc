"""Readers for landing files, seeds and tables."""

from moonstride.sources.landing import newest_snapshot, read_landing, read_newest, unreadable_files
from moonstride.sources.seeds import read_activity_mapping, read_moon_calendar
from moonstride.sources.tables import read_table

__all__ = [
    "newest_snapshot",
    "read_activity_mapping",
    "read_landing",
    "read_moon_calendar",
    "read_newest",
    "read_table",
    "unreadable_files",
]
