"""Intermediate models: numbering, units and lookups at the grain of the source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.functions.measures import (
    as_decimal2,
    hours_from_minutes,
    hours_from_seconds,
    kilometers,
    kilometers_per_hour,
    minutes_from_seconds,
)
from moonstride.functions.times import day_of, minutes_crossed, night_date
from moonstride.operators.lookups import left_lookup
from moonstride.operators.sequence import number_by_time
from moonstride.plans.names import DEFAULT_NAMES, Names


def _with_activity_name(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Swap the source's name of the activity for the common name and the sport flag."""
    return (
        left_lookup(df, mapping, key, "original_activity_name")
        .withColumnRenamed("aligned_activity_name", "activity_name")
        .drop(key)
    )


def activities(
    staged: DataFrame, mapping: DataFrame, names: Names = DEFAULT_NAMES, numbered: bool = True
) -> DataFrame:
    """Activities with running numbers, converted measures and the common activity name.

    Equal start times are numbered by source id. For those who read no number, ``numbered=False``
    leaves both out and sorts nothing.
    """
    number = f"{names.track}_activity_id"
    numbers = (number, f"{number}_of_day") if numbered else ()
    rows = number_by_time(staged, "start_date", "activity_id", *numbers) if numbered else staged
    length = F.col("distance")
    measures = {"distance_meters": as_decimal2(length), "distance_kilometers": kilometers(length)}
    for time in ("moving_time", "elapsed_time"):
        measures |= {
            f"{time}_seconds": F.col(time).cast("decimal(10,2)"),
            f"{time}_minutes": minutes_from_seconds(F.col(time)),
            f"{time}_hours": hours_from_seconds(F.col(time)),
        }
    measures["total_elevation_gain_meters"] = as_decimal2(F.col("total_elevation_gain"))
    for speed in ("average_speed", "max_speed"):
        measures |= {
            f"{speed}_meters_per_second": as_decimal2(F.col(speed)),
            f"{speed}_kilometers_per_hour": kilometers_per_hour(F.col(speed)),
        }
    replaced = ("distance", "moving_time", "elapsed_time", "total_elevation_gain", "average_speed", "max_speed")
    first = ("activity_id", number, f"{number}_of_day", "name", "type", "start_date", "start_date_local", "timezone")
    rest = [c for c in staged.columns if c not in replaced and c not in first]
    shaped = rows.select(
        F.col("activity_id").alias(f"{number}_internal"),
        *numbers,
        "name",
        "type",
        day_of(F.col("start_date")).alias("date_day"),
        "start_date",
        "start_date_local",
        "timezone",
        *(value.alias(name) for name, value in measures.items()),
        *rest,
    )
    return _with_activity_name(shaped, mapping, "sport_type")


def nights(staged: DataFrame, moon: DataFrame | None) -> DataFrame:
    """Sleeps with the night they belong to, hours and the moon of that night.

    The source's id becomes ``source_sleep_id``. Without a moon calendar there are no moon columns.
    """

    def both_units(*columns: str):
        for c in columns:
            yield F.col(c).alias(f"{c}_minutes")
            yield hours_from_minutes(F.col(c)).alias(f"{c}_hours")

    shaped = staged.select(
        F.col("sleep_id").alias("source_sleep_id"),
        night_date(F.col("sleep_onset"), F.col("nap")).alias("date_day"),
        day_of(F.col("sleep_onset")).alias("sleep_start_date"),
        "sleep_onset",
        day_of(F.col("wake_onset")).alias("wake_up_date"),
        "wake_onset",
        *both_units(
            "asleep_duration",
            "in_bed_duration",
            "light_sleep_duration",
            "deep_sleep_duration",
            "rem_duration",
            "awake_duration",
        ),
        "sleep_performance",
        "respiratory_rate",
        *both_units("sleep_need", "sleep_debt"),
        "sleep_efficiency",
        "sleep_consistency",
        "nap",
    )
    if moon is None:
        return shaped
    night = moon.select(
        "date_day",
        "moon_phase",
        F.col("illumination").alias("moon_illumination"),
        F.col("phase_cycle").alias("moon_phase_cycle"),
    )
    return left_lookup(shaped, night, "date_day", "date_day")


def numbered_sleeps(staged: DataFrame, moon: DataFrame | None = None) -> DataFrame:
    """``nights`` with running numbers; that of the day follows the onset, not the night."""
    dated = nights(staged, moon)
    return number_by_time(dated, "sleep_onset", "source_sleep_id", "sleep_id", "sleep_id_of_day")


def sleeps(staged: DataFrame, moon: DataFrame) -> DataFrame:
    return numbered_sleeps(staged, moon).drop("source_sleep_id")


def workouts(
    staged: DataFrame, mapping: DataFrame, names: Names = DEFAULT_NAMES, numbered: bool = True
) -> DataFrame:
    """Workouts with running numbers (unless ``numbered=False``), duration and the common activity name."""
    number = f"{names.body}_workout_id"
    numbers = (number, f"{number}_of_day") if numbered else ()
    rows = number_by_time(staged, "workout_start_time", "workout_id", *numbers) if numbered else staged
    start, end = F.col("workout_start_time"), F.col("workout_end_time")
    times = ("workout_id", "workout_start_time", "workout_end_time", "sport_id")
    shaped = rows.select(
        *numbers,
        day_of(start).alias("date_day"),
        start,
        end,
        minutes_crossed(start, end).alias("duration_minutes"),
        *(c for c in staged.columns if c not in times),
    )
    return _with_activity_name(shaped, mapping, "source_activity_name")


def physiological_cycles(cycles: DataFrame, recoveries: DataFrame, sleeps_with_source: DataFrame) -> DataFrame:
    """Cycles with their recovery and the sleep the recovery is based on.

    ``sleeps_with_source`` is ``numbered_sleeps`` and needs no moon. One row per cycle as long as
    recoveries are unique per cycle.
    """
    slept = sleeps_with_source.drop("moon_phase", "moon_illumination", "moon_phase_cycle", "nap")
    recovered = left_lookup(cycles, recoveries, "cycle_id", "cycle_id")
    return left_lookup(recovered, slept, "source_sleep_id", "source_sleep_id").drop("source_sleep_id")
