"""Staging: raw records to typed columns, one row in, one row out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moonstride.functions.measures import as_decimal2, as_integer, minutes_from_millis
from moonstride.sources.seeds import moon_calendar_columns

__all__ = [
    "flatten_activities",
    "moon_calendar_columns",
    "stage_activities",
    "stage_activity_mapping",
    "stage_cycles",
    "stage_recoveries",
    "stage_sleeps",
    "stage_workouts",
]

_POINTS = ("start", "end")

# Columns of staged activities and their types, in order.
ACTIVITY_COLUMNS = """
    activity_id bigint, name string, type string, sport_type string,
    start_date timestamp_ntz, start_date_local timestamp_ntz, timezone string,
    distance double, moving_time int, elapsed_time int, total_elevation_gain double,
    average_speed double, max_speed double,
    average_heartrate double, max_heartrate double, average_watts double,
    kilojoules double, average_cadence double,
    achievement_count int, kudos_count int, comment_count int, athlete_count int,
    trainer boolean, commute boolean, manual boolean, private boolean, flagged boolean,
    gear_id string,
    start_latitude double, start_longitude double, end_latitude double, end_longitude double,
    extracted_at timestamp_ntz
"""


def flatten_activities(raw: DataFrame) -> DataFrame:
    """Landing records to flat rows; an absent or empty coordinate pair gives nulls.

    ``extracted_at`` is the load time, one value per batch.
    """
    flat = [c for c in raw.columns if c != "id" and not c.endswith("_latlng")]
    coordinates = [
        F.get(F.col(f"{point}_latlng"), index).alias(f"{point}_{axis}")
        for point in _POINTS
        for index, axis in enumerate(("latitude", "longitude"))
    ]
    return raw.select(
        F.col("id").alias("activity_id"), *flat, *coordinates, F.localtimestamp().alias("extracted_at")
    )


def _moment(name: str) -> Column:
    """Time without zone; an offset in the text is dropped."""
    return F.col(name).cast("timestamp_ntz")


def stage_activities(flat: DataFrame) -> DataFrame:
    """The columns of ``ACTIVITY_COLUMNS``, cast to their types; any other raw column is left out.

    A text that is no number gives null.
    """

    def typed(name: str, kind: T.DataType) -> Column:
        column = F.col(name)
        if isinstance(kind, T.TimestampNTZType):
            return _moment(name)
        if isinstance(kind, T.IntegerType):
            return as_integer(column.try_cast("double"))
        if isinstance(kind, T.StringType):
            return column.cast("string")
        return column.try_cast(kind)

    layout = T.StructType.fromDDL(ACTIVITY_COLUMNS)
    return flat.select(*(typed(f.name, f.dataType).alias(f.name) for f in layout.fields))


def stage_sleeps(raw: DataFrame) -> DataFrame:
    """Typed sleeps: nested stage and need times as minutes, scores as decimals."""

    def stage_time(name: str) -> Column:
        return F.col(f"score.stage_summary.total_{name}_time_milli")

    def need(name: str) -> Column:
        return F.col(f"score.sleep_needed.{name}")

    def score(name: str) -> Column:
        return as_decimal2(F.col(f"score.{name}"))

    asleep = stage_time("light_sleep") + stage_time("slow_wave_sleep") + stage_time("rem_sleep")
    needed = (
        need("baseline_milli")
        + need("need_from_sleep_debt_milli")
        + need("need_from_recent_strain_milli")
        - need("need_from_recent_nap_milli")
    )
    minutes = {
        "asleep_duration": asleep,
        "in_bed_duration": stage_time("in_bed"),
        "light_sleep_duration": stage_time("light_sleep"),
        "deep_sleep_duration": stage_time("slow_wave_sleep"),
        "rem_duration": stage_time("rem_sleep"),
        "awake_duration": stage_time("awake"),
        "sleep_need": needed,
        "sleep_debt": need("need_from_sleep_debt_milli"),
    }
    return raw.select(
        F.col("id").cast("string").alias("sleep_id"),
        _moment("start").alias("sleep_onset"),
        _moment("end").alias("wake_onset"),
        score("sleep_performance_percentage").alias("sleep_performance"),
        score("respiratory_rate").alias("respiratory_rate"),
        *(minutes_from_millis(millis).alias(name) for name, millis in minutes.items()),
        score("sleep_efficiency_percentage").alias("sleep_efficiency"),
        score("sleep_consistency_percentage").alias("sleep_consistency"),
        F.col("nap").cast("boolean").alias("nap"),
    )


def stage_workouts(raw: DataFrame) -> DataFrame:
    """Typed workouts; ids, times and names up, score and zones flattened."""
    zones = [f"zone_{n}_milli" for n in ("zero", "one", "two", "three", "four", "five")]
    measures = ("kilojoule", "percent_recorded", "distance_meter", "altitude_gain_meter", "altitude_change_meter")
    return raw.select(
        F.col("id").cast("string").alias("workout_id"),
        _moment("start").alias("workout_start_time"),
        _moment("end").alias("workout_end_time"),
        F.col("sport_name").cast("string").alias("source_activity_name"),
        F.col("score.strain").cast("double").alias("activity_strain"),
        as_integer(F.col("score.average_heart_rate")).alias("average_heart_rate"),
        as_integer(F.col("score.max_heart_rate")).alias("max_heart_rate"),
        *(F.col(f"score.{m}").cast("double").alias(m) for m in measures),
        *(F.col(f"score.zone_durations.{z}").cast("bigint").alias(z) for z in zones),
        as_integer(F.col("sport_id")).alias("sport_id"),
    )


def stage_activity_mapping(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("activity_name").cast("string").alias("original_activity_name"),
        F.col("aligned_activity_name").cast("string").alias("aligned_activity_name"),
        F.col("is_sport_exercise").cast("boolean").alias("is_sport_exercise"),
    )


# calories per kilojoule
_CALORIES = 1 / 4.184


def stage_cycles(raw: DataFrame) -> DataFrame:
    """Typed physiological cycles; an open cycle has no end."""
    return raw.select(
        F.col("id").cast("bigint").alias("cycle_id"),
        _moment("start").alias("cycle_start_time"),
        _moment("end").alias("cycle_end_time"),
        F.col("timezone_offset").alias("cycle_timezone"),
        F.col("score.strain").cast("double").alias("day_strain"),
        (F.col("score.kilojoule").cast("double") * F.lit(_CALORIES)).alias("energy_burned"),
        as_integer(F.col("score.max_heart_rate")).alias("max_hr"),
        as_integer(F.col("score.average_heart_rate")).alias("average_hr"),
    )


def stage_recoveries(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("cycle_id").cast("bigint").alias("cycle_id"),
        F.col("sleep_id").cast("string").alias("source_sleep_id"),
        F.col("score.recovery_score").cast("double").alias("recovery_score"),
        F.col("score.resting_heart_rate").cast("double").alias("resting_heart_rate"),
        F.col("score.hrv_rmssd_milli").cast("double").alias("heart_rate_variability"),
        F.col("score.skin_temp_celsius").cast("double").alias("skin_temp"),
        F.col("score.spo2_percentage").cast("double").alias("blood_oxygen"),
    )
