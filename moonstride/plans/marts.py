"""Facts and dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from moonstride.operators.availability import availability_flags, day_bitmaps, merged
from moonstride.operators.calendar import calendar_from
from moonstride.operators.filters import all_present
from moonstride.operators.lookups import existence_flags, foreign_key
from moonstride.operators.sequence import surrogate_keys
from moonstride.operators.summary import members
from moonstride.plans.names import DEFAULT_NAMES, Names

_SOCIAL = ("achievement_count", "kudos_count", "comment_count", "athlete_count")
_FLAGS = ("trainer", "commute", "manual", "private", "flagged")
_MOON = ("moon_phase", "moon_phase_cycle", "moon_illumination")
_TYPE_KEYS = ("type", "activity_name", "is_sport_exercise")


def activity_types(activities: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    """One row per known combination of type, activity name and sport flag."""
    known = activities.where(all_present("type", "activity_name"))
    return surrogate_keys(members(known, *_TYPE_KEYS), _TYPE_KEYS, f"{names.track}_activity_type_id")


def gear(activities: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    """One row per gear; "no gear" is a member and comes last."""
    return surrogate_keys(members(activities, "gear_id"), ("gear_id",), f"{names.track}_gear_id")


def workout_activities(workouts: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    keys = ("activity_name", "is_sport_exercise")
    return surrogate_keys(members(workouts, *keys), keys, f"{names.body}_workout_activity_name_id")


def keyed_activities(
    activities: DataFrame, types: DataFrame, gears: DataFrame, names: Names = DEFAULT_NAMES
) -> DataFrame:
    """Activities with the foreign keys of type and gear."""
    typed = foreign_key(activities, types, _TYPE_KEYS, f"{names.track}_activity_type_id")
    return foreign_key(typed, gears, ("gear_id",), f"{names.track}_gear_id", null_safe=True)


def _activity_head(names: Names) -> list[str]:
    number = f"{names.track}_activity_id"
    keys = [f"{names.track}_activity_type_id", f"{names.track}_gear_id"]
    return [number, f"{number}_of_day", "name", "date_day", *keys]


def fact_activities(keyed: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    """Measures, places and health values; one row per activity."""
    head = _activity_head(names)
    left_out = {
        *head, *_SOCIAL, *_FLAGS, *_TYPE_KEYS, f"{names.track}_activity_id_internal",
        "start_date", "start_date_local", "timezone", "gear_id", "extracted_at",
    }
    return keyed.select(*head, *(c for c in keyed.columns if c not in left_out))


def fact_activity_socials(keyed: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    """Counts and flags of the same activities."""
    return keyed.select(*_activity_head(names), *_SOCIAL, *_FLAGS)


def semantic_activities(fact: DataFrame, types: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    """The fact reduced to what questions need, with the activity name resolved."""
    key = f"{names.track}_activity_type_id"
    number = f"{names.track}_activity_id"
    slim = fact.select(number, f"{number}_of_day", "date_day", "name", key)
    return slim.join(types.drop("type"), key, "left").drop(key)


def _sleep_head(sleeps: DataFrame) -> list[str]:
    return sleeps.columns[: sleeps.columns.index("wake_onset") + 1]


def fact_sleeps(sleeps: DataFrame) -> DataFrame:
    """Durations of a sleep in minutes and hours."""
    durations = [c for c in sleeps.columns if "_duration_" in c]
    return sleeps.select(*_sleep_head(sleeps), *durations, *_MOON)


def fact_sleep_quality(sleeps: DataFrame) -> DataFrame:
    """Scores, need and debt of the same sleeps."""
    scores = [c for c in sleeps.columns if c not in _sleep_head(sleeps) and "_duration_" not in c]
    return sleeps.select(*_sleep_head(sleeps), *(c for c in scores if c not in _MOON), *_MOON)


def fact_workouts(workouts: DataFrame) -> DataFrame:
    """All workout columns, the activity right after the times."""
    named = ("activity_name", "is_sport_exercise")
    head = workouts.columns[: workouts.columns.index("duration_minutes") + 1]
    rest = [c for c in workouts.columns if c not in (*head, *named)]
    return workouts.select(*head, *named, *rest)


def dashboard_feed(sleeps: DataFrame) -> DataFrame:
    """Durations in minutes of the nights with a known moon phase."""
    minutes = [c for c in sleeps.columns if c.endswith("_duration_minutes")]
    return sleeps.where(all_present("asleep_duration_minutes", "moon_phase")).select(
        "date_day", *minutes, "moon_phase"
    )


def dim_dates(fact: DataFrame, end: date | None = None) -> DataFrame:
    return calendar_from(fact, "date_day", end)


def data_check(
    dates: DataFrame, sleeps: DataFrame, workouts: DataFrame, activities: DataFrame, names: Names = DEFAULT_NAMES
) -> DataFrame:
    """Per day: is there a sleep, a workout, an activity?"""
    sources = {
        f"is_{names.body}_sleeps_data_available": (sleeps, "date_day"),
        f"is_{names.body}_workouts_data_available": (workouts, "date_day"),
        f"is_{names.track}_activities_data_available": (activities, "date_day"),
    }
    return existence_flags(dates.select("date_day", "day_name", "is_weekend"), "date_day", sources)


def day_bitmaps_of(
    sleeps: DataFrame | None = None, workouts: DataFrame | None = None, activities: DataFrame | None = None,
    names: Names = DEFAULT_NAMES,
) -> DataFrame:
    """The days of the rows given as bitmaps per source; add those of a load to the stored ones with ``merged``."""
    given = {f"{names.body}_sleeps": sleeps, f"{names.body}_workouts": workouts, f"{names.track}_activities": activities}
    return merged(*(day_bitmaps(rows, source) for source, rows in given.items() if rows is not None))


def data_check_from_bitmaps(dates: DataFrame, bitmaps: DataFrame, names: Names = DEFAULT_NAMES) -> DataFrame:
    """``data_check`` read off stored bitmaps; the sources are not looked at."""
    sources = (f"{names.body}_sleeps", f"{names.body}_workouts", f"{names.track}_activities")
    flags = {f"is_{source}_data_available": source for source in sources}
    return availability_flags(dates.select("date_day", "day_name", "is_weekend"), bitmaps, flags)
