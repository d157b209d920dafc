"""The checks declared for the models, and the job that runs them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.operators.quality import Check, calendar_horizon, run_suite
from moonstride.plans.names import DEFAULT_NAMES, Names

# Accepted activity types and names.
ACTIVITY_TYPES = (
    "Ride", "Racquetball", "NordicSki", "Workout", "WeightTraining",
    "HighIntensityIntervalTraining", "Crossfit", "Hike", "Yoga", "Run", "Swim",
)
WORKOUT_NAMES = (
    "powerlifting", "sauna", "watching-sports", "hiking-rucking", "sculpt-yoga", "padel",
    "swimming", "increase_relaxation", "dog-walking", "hiit", "activity", "dance",
    "ski-touring", "commuting", "yoga", "badminton", "running", "walking", "weightlifting",
    "table-tennis", "cycling",
)


# Measures of a cycle that are not negative.
CYCLE_MEASURES = (
    "recovery_score", "resting_heart_rate", "heart_rate_variability", "skin_temp", "blood_oxygen",
    "day_strain", "energy_burned", "max_hr", "average_hr", "sleep_performance", "respiratory_rate",
    "asleep_duration_minutes", "in_bed_duration_minutes", "light_sleep_duration_minutes",
    "deep_sleep_duration_minutes", "rem_duration_minutes", "awake_duration_minutes",
    "sleep_need_minutes", "sleep_debt_minutes", "sleep_efficiency", "sleep_consistency",
)


def _each(kind: str, columns: Iterable[str], argument=None) -> list[Check]:
    return [Check(kind, column, argument) for column in columns]


def _present(*columns: str) -> list[Check]:
    return _each("not_null", columns)


def _key(column: str) -> list[Check]:
    return [Check("not_null", column), Check("unique", column)]


# Measures of the other models that are not negative, or not missing.
SLEEP_MEASURES = (
    "asleep_duration", "in_bed_duration", "light_sleep_duration", "deep_sleep_duration", "rem_duration",
    "awake_duration", "sleep_need", "sleep_debt", "sleep_performance", "respiratory_rate",
    "sleep_efficiency", "sleep_consistency",
)
WORKOUT_MEASURES = (
    "activity_strain", "average_heart_rate", "max_heart_rate", "kilojoule", "percent_recorded",
    "zone_zero_milli", "zone_one_milli", "zone_two_milli", "zone_three_milli", "zone_four_milli",
    "zone_five_milli",
)
ACTIVITY_MEASURES = (
    "distance_meters", "distance_kilometers", "moving_time_seconds", "moving_time_minutes",
    "moving_time_hours", "elapsed_time_seconds", "elapsed_time_minutes", "elapsed_time_hours",
    "total_elevation_gain_meters", "average_speed_meters_per_second",
    "average_speed_kilometers_per_hour", "max_speed_meters_per_second", "max_speed_kilometers_per_hour",
)


def declared_checks(names: Names = DEFAULT_NAMES) -> dict[str, list[Check]]:
    """Every check by model and column. A parent is given by the name of its model."""
    track, body = names.track, names.body
    activity, workout = f"{track}_activity_id", f"{body}_workout_id"
    numbered = _key(activity) + _present(f"{activity}_of_day", "date_day")
    return {
        "stg_seeds_activity_mapping": _key("original_activity_name")
        + _present("aligned_activity_name", "is_sport_exercise"),
        f"stg_{track}_activities": _key("activity_id")
        + _present("name", "type", "sport_type", "start_date", "start_date_local", "timezone", "extracted_at")
        + [Check("accepted_values", "type", ACTIVITY_TYPES)],
        f"stg_{body}_sleep": _key("sleep_id")
        + _present("sleep_onset", "wake_onset", "sleep_performance", "respiratory_rate")
        + _each("at_least", SLEEP_MEASURES, 0)
        + [Check("accepted_values", "nap", (True, False))],
        f"stg_{body}_workouts": _key("workout_id")
        + _present("workout_start_time", "workout_end_time", "source_activity_name")
        + _each("at_least", WORKOUT_MEASURES, 0)
        + [Check("at_most", "percent_recorded", 100), Check("accepted_values", "source_activity_name", WORKOUT_NAMES)],
        f"int_{track}_activities": _key(f"{activity}_internal")
        + numbered
        + _present("start_date", "start_date_local", "extracted_at", *ACTIVITY_MEASURES),
        f"int_{body}_sleep": _key("sleep_id")
        + _present("sleep_id_of_day", "date_day", "sleep_start_date", "wake_up_date")
        + [Check("relationships", "date_day", "date_day", parent="stg_seeds_moon_data")],
        f"int_{body}_workouts": _key(workout)
        + _present(f"{workout}_of_day", "date_day", "workout_start_time", "workout_end_time")
        + [Check("at_least", "duration_minutes", 0)],
        f"stg_{body}_cycles": _key("cycle_id"),
        f"stg_{body}_recoveries": _key("cycle_id"),
        f"fct_{body}_physiological_cycles": _present(
            "cycle_start_time", "cycle_end_time", "cycle_timezone", "sleep_onset", "wake_onset",
            "sleep_performance", "respiratory_rate",
        )
        + _each("at_least", CYCLE_MEASURES, 0)
        + [Check("unique", "sleep_id"), Check("relationships", "sleep_id", "sleep_id", parent=f"int_{body}_sleep")],
        "fct_activities": numbered + _present("activity_name"),
        "dim_dates": _key("date_day"),
    }


def checks_for(models: dict[str, DataFrame], names: Names = DEFAULT_NAMES) -> dict[str, list[Check]]:
    """The declared checks of the models given, parents included; a column that a model lacks is an error."""

    def resolved(check: Check) -> Check:
        return replace(check, parent=models[check.parent]) if isinstance(check.parent, str) else check

    return {model: [resolved(c) for c in checks] for model, checks in declared_checks(names).items() if model in models}


def run_checks(
    models: dict[str, DataFrame], names: Names = DEFAULT_NAMES, as_of: date | None = None
) -> DataFrame:
    """One row per declared check with its number of violations; 0 is a pass."""
    suites = [run_suite(models[m], m, checks) for m, checks in checks_for(models, names).items()]
    if "dim_dates" in models:
        spent = calendar_horizon(models["dim_dates"], as_of)
        suites.append(
            spent.groupBy()
            .agg(F.count(F.lit(1)).alias("violations"), F.coalesce(F.max("severity"), F.lit("error")).alias("s"))
            .select(
                F.lit("dim_dates").alias("table_name"),
                F.lit("date_day").alias("column_name"),
                F.lit("calendar_horizon").alias("check_name"),
                F.col("s").alias("severity"),
                "violations",
            )
        )
    return reduce(DataFrame.union, suites)
