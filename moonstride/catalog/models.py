"""The models as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.catalog.standins import (
    ACTIVITY_SQL,
    GEAR_SQL,
    KEYED_ACTIVITY_SQL,
    MOON_PHASES,
    NIGHT_SQL,
    SLEEP_SQL,
    STAGED_SLEEP_SQL,
    TYPE_SQL,
    WORKOUT_SQL,
    activity_records,
    cycle_records,
    mapping_seed,
    moon_seed,
    recovery_records,
    sleep_records,
    workout_records,
)
from moonstride.catalog.times import CALENDAR_END
from moonstride.operators.availability import merged
from moonstride.operators.summary import count_per, in_spine_order, summary_per_category
from moonstride.plans import intermediate, marts, staging
from moonstride.session import stage
from moonstride.sources.literals import literal_table


def _activities(t: Tables, numbered: bool = True) -> DataFrame:
    flat = staging.flatten_activities(activity_records(t.events))
    mapping = staging.stage_activity_mapping(mapping_seed(t.spark))
    return intermediate.activities(staging.stage_activities(flat), mapping, numbered=numbered)


def _activity_table(t: Tables) -> DataFrame:
    """Activities as a table, for models that read them several times."""
    return stage(_activities(t), "activities")


def _keyed(activities: DataFrame) -> DataFrame:
    return marts.keyed_activities(activities, marts.activity_types(activities), marts.gear(activities))


def _nights(t: Tables) -> DataFrame:
    staged = staging.stage_sleeps(sleep_records(t.events))
    return intermediate.nights(staged, staging.moon_calendar_columns(moon_seed(t.spark)))


def _sleeps(t: Tables, staged: DataFrame | None = None) -> DataFrame:
    staged = staging.stage_sleeps(sleep_records(t.events)) if staged is None else staged
    return intermediate.numbered_sleeps(staged, staging.moon_calendar_columns(moon_seed(t.spark)))


def _workouts(t: Tables, numbered: bool = True, staged: DataFrame | None = None) -> DataFrame:
    mapping = staging.stage_activity_mapping(mapping_seed(t.spark))
    staged = staging.stage_workouts(workout_records(t.events)) if staged is None else staged
    return intermediate.workouts(staged, mapping, numbered=numbered)


@query(f"SELECT * FROM {STAGED_SLEEP_SQL} s")
def model_staged_sleep(t: Tables) -> DataFrame:
    """Sleeps after staging."""
    return staging.stage_sleeps(sleep_records(t.events))


STAGED_WORKOUT_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS workout_id, ts AS workout_start_time,
        ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS workout_end_time,
        event_type AS source_activity_name, CASE WHEN scored THEN value / 9 END AS activity_strain,
        CASE WHEN scored THEN CAST(user_id % 60 + 90.5 AS DOUBLE)::INTEGER END AS average_heart_rate,
        CASE WHEN scored THEN CAST(user_id % 60 + 120.5 AS DOUBLE)::INTEGER END AS max_heart_rate,
        CASE WHEN scored THEN value * 13 END AS kilojoule,
        CASE WHEN scored THEN CAST(event_id % 101 AS DOUBLE) END AS percent_recorded,
        CASE WHEN scored AND event_id % 6 <> 0 THEN value * 70 END AS distance_meter,
        CASE WHEN scored THEN value / 2 END AS altitude_gain_meter,
        CASE WHEN scored THEN -value / 2 END AS altitude_change_meter,
        CASE WHEN scored THEN CAST(user_id * 100 AS BIGINT) END AS zone_zero_milli,
        CASE WHEN scored THEN CAST(user_id * 200 AS BIGINT) END AS zone_one_milli,
        CASE WHEN scored THEN CAST(user_id * 300 AS BIGINT) END AS zone_two_milli,
        CASE WHEN scored THEN CAST(user_id * 400 AS BIGINT) END AS zone_three_milli,
        CASE WHEN scored THEN CAST(user_id * 500 AS BIGINT) END AS zone_four_milli,
        CASE WHEN scored THEN CAST(user_id * 600 AS BIGINT) END AS zone_five_milli,
        CAST(user_id % 9 AS INTEGER) AS sport_id
    FROM (SELECT *, event_id % 17 <> 0 AS scored FROM events) e"""


@query(STAGED_WORKOUT_SQL)
def model_staged_workouts(t: Tables) -> DataFrame:
    """Workouts after staging, with all columns."""
    return staging.stage_workouts(workout_records(t.events))


@query(f"SELECT * FROM {ACTIVITY_SQL} a")
def model_activities(t: Tables) -> DataFrame:
    """Activities before they are split into facts and dimensions."""
    return _activities(t).drop("extracted_at")


@query(f"""
    SELECT * EXCLUDE (track_activity_id_internal, type, start_date, start_date_local, timezone, gear_id,
        achievement_count, kudos_count, comment_count, athlete_count, trainer, commute, manual, private,
        flagged, activity_name, is_sport_exercise)
    FROM {KEYED_ACTIVITY_SQL} k""")
def model_star(t: Tables) -> DataFrame:
    """The activity fact with its foreign keys."""
    return marts.fact_activities(_keyed(_activity_table(t)))


@query(f"""
    SELECT track_activity_id, track_activity_id_of_day, name, date_day, track_activity_type_id, track_gear_id,
        achievement_count, kudos_count, comment_count, athlete_count, trainer, commute, manual, private, flagged
    FROM {KEYED_ACTIVITY_SQL} k""")
def model_socials(t: Tables) -> DataFrame:
    """The second fact of the same grain."""
    return marts.fact_activity_socials(_keyed(_activity_table(t)))


@query(f"SELECT * FROM {TYPE_SQL} t")
def model_activity_types(t: Tables) -> DataFrame:
    return marts.activity_types(_activities(t, numbered=False))


@query(f"SELECT * FROM {GEAR_SQL} g")
def model_gear(t: Tables) -> DataFrame:
    return marts.gear(_activities(t, numbered=False))


@query(f"""
    SELECT date_day, count(*) AS activity_count
    FROM (SELECT k.date_day, t.activity_name FROM {KEYED_ACTIVITY_SQL} k
          LEFT JOIN {TYPE_SQL} t ON k.track_activity_type_id = t.track_activity_type_id) s
    WHERE activity_name = 'Run' GROUP BY 1 ORDER BY 1""")
def model_runs_per_day(t: Tables) -> DataFrame:
    """Through all layers: records, numbers, names, star, semantic fact, runs per day."""
    activities = _activity_table(t)
    types = marts.activity_types(activities)
    fact = marts.fact_activities(marts.keyed_activities(activities, types, marts.gear(activities)))
    semantic = marts.semantic_activities(fact, types)
    return count_per(semantic.where(F.col("activity_name") == "Run"), "date_day")


SEMANTIC_SQL = f"""
    SELECT k.track_activity_id, k.track_activity_id_of_day, k.date_day, k.name, t.activity_name, t.is_sport_exercise
    FROM {KEYED_ACTIVITY_SQL} k LEFT JOIN {TYPE_SQL} t ON k.track_activity_type_id = t.track_activity_type_id"""


def _semantic(t: Tables) -> DataFrame:
    activities = _activities(t)  # its numbered rows are written; few columns of them are read here
    types = marts.activity_types(activities)
    fact = marts.fact_activities(marts.keyed_activities(activities, types, marts.gear(activities)))
    return marts.semantic_activities(fact, types)


@query(SEMANTIC_SQL)
def model_semantic_activities(t: Tables) -> DataFrame:
    """The activity fact with names instead of keys, all its rows."""
    return _semantic(t)


@query(f"SELECT * EXCLUDE (source_sleep_id) FROM {NIGHT_SQL} n")
def model_sleep(t: Tables) -> DataFrame:
    """Sleeps with numbers, nights, hours and moon."""
    return _sleeps(t).drop("source_sleep_id")


@query(f"""
    SELECT sleep_id, sleep_id_of_day, date_day, sleep_start_date, sleep_onset, wake_up_date, wake_onset,
        asleep_duration_minutes, asleep_duration_hours, in_bed_duration_minutes, in_bed_duration_hours,
        light_sleep_duration_minutes, light_sleep_duration_hours, deep_sleep_duration_minutes,
        deep_sleep_duration_hours, rem_duration_minutes, rem_duration_hours, awake_duration_minutes,
        awake_duration_hours, moon_phase, moon_phase_cycle, moon_illumination
    FROM {NIGHT_SQL} n""")
def model_sleep_durations(t: Tables) -> DataFrame:
    return marts.fact_sleeps(_sleeps(t).drop("source_sleep_id"))


@query(f"""
    SELECT sleep_id, sleep_id_of_day, date_day, sleep_start_date, sleep_onset, wake_up_date, wake_onset,
        sleep_performance, respiratory_rate, sleep_need_minutes, sleep_need_hours, sleep_debt_minutes,
        sleep_debt_hours, sleep_efficiency, sleep_consistency, nap, moon_phase, moon_phase_cycle,
        moon_illumination
    FROM {NIGHT_SQL} n""")
def model_sleep_quality(t: Tables) -> DataFrame:
    return marts.fact_sleep_quality(_sleeps(t).drop("source_sleep_id"))


_SUMMARY_COLUMNS = {
    "in_bed": "in_bed_duration_minutes",
    "asleep": "asleep_duration_minutes",
    "awake": "awake_duration_minutes",
    "light": "light_sleep_duration_minutes",
    "deep": "deep_sleep_duration_minutes",
    "rem": "rem_duration_minutes",
}
_PHASE_ROWS = [(name, i) for i, name in enumerate(MOON_PHASES)]


@query(f"""
    SELECT p.label, CAST(p.ordinal AS INTEGER) AS ordinal, s.* EXCLUDE (category)
    FROM (VALUES {", ".join(map(str, _PHASE_ROWS))}) p(label, ordinal)
    JOIN (SELECT lower(trim(moon_phase)) AS category, count(*) AS nights,
            {", ".join(
                f"round(avg({c}), 6) AS {s}_minutes, round(avg({c}) / 60, 6) AS {s}_hours, "
                f"printf('%02d:%02d', CAST(round(avg({c})) AS BIGINT) // 60, "
                f"CAST(round(avg({c})) AS BIGINT) % 60) AS {s}_hhmm"
                for s, c in _SUMMARY_COLUMNS.items())}
          FROM {NIGHT_SQL} n WHERE asleep_duration_minutes IS NOT NULL AND moon_phase IS NOT NULL
          GROUP BY 1) s ON lower(p.label) = s.category
    ORDER BY 2""")
def model_moon_summary(t: Tables) -> DataFrame:
    """The dashboard: mean sleep per moon phase, in the order of the phases."""
    feed = marts.dashboard_feed(_nights(t))
    summary = summary_per_category(feed, "moon_phase", _SUMMARY_COLUMNS)
    rounded = [c for c in summary.columns if c.endswith(("_minutes", "_hours"))]
    summary = summary.withColumns({c: F.round(c, 6) for c in rounded})
    return in_spine_order(summary, literal_table(t.spark, "category string, ordinal int", _PHASE_ROWS))


@query(f"SELECT * FROM {WORKOUT_SQL} w")
def model_workouts(t: Tables) -> DataFrame:
    return marts.fact_workouts(_workouts(t))


@query(f"""
    SELECT row_number() OVER (ORDER BY activity_name NULLS LAST) AS body_workout_activity_name_id, *
    FROM (SELECT DISTINCT activity_name, is_sport_exercise FROM {WORKOUT_SQL} w) d""")
def model_workout_activities(t: Tables) -> DataFrame:
    """The workout dimension; "no name" is its last member."""
    return marts.workout_activities(_workouts(t, numbered=False))


_DATA_CHECK_SQL = f"""
    SELECT CAST(d AS DATE) AS date_day, strftime(d, '%A') AS day_name,
        strftime(d, '%w') IN ('0', '6') AS is_weekend,
        EXISTS (SELECT 1 FROM {NIGHT_SQL} n WHERE n.date_day = CAST(d AS DATE)) AS is_body_sleeps_data_available,
        EXISTS (SELECT 1 FROM {WORKOUT_SQL} w WHERE w.date_day = CAST(d AS DATE))
            AS is_body_workouts_data_available,
        EXISTS (SELECT 1 FROM events e WHERE CAST(e.ts AS DATE) = CAST(d AS DATE))
            AS is_track_activities_data_available
    FROM (SELECT unnest(generate_series((SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) FROM events),
                 TIMESTAMP '{CALENDAR_END}' - INTERVAL '1 day', INTERVAL '1 day')) AS d) s"""


@query(_DATA_CHECK_SQL)
def model_data_check(t: Tables) -> DataFrame:
    """Which data exists for each day of the calendar."""
    activities = _activities(t, numbered=False)
    dates = marts.dim_dates(activities, CALENDAR_END)
    return marts.data_check(dates, _nights(t), _workouts(t, numbered=False), activities)


@query(_DATA_CHECK_SQL)
def model_data_check_stored(t: Tables) -> DataFrame:
    """The same from stored bitmaps: those of a first load, then those of late rows, some of them loaded twice."""
    nights, workouts, activities = _nights(t), _workouts(t, numbered=False), _activities(t, numbered=False)
    late = F.dayofmonth("date_day") % 3 == 0
    early = [rows.where(~late) for rows in (nights, workouts, activities)]
    stored = stage(marts.day_bitmaps_of(*early), "bitmaps")
    for rows in ({"sleeps": nights.where(late)}, {"workouts": workouts, "activities": activities.where(late)}):
        stored = stage(merged(stored, marts.day_bitmaps_of(**rows)), "bitmaps")
    return marts.data_check_from_bitmaps(marts.dim_dates(activities, CALENDAR_END), stored)


@query(f"""
    SELECT c.event_id AS cycle_id, c.ts AS cycle_start_time,
        CASE WHEN c.event_id % 9 <> 0 THEN c.ts + INTERVAL '1 day' END AS cycle_end_time,
        '-05:00' AS cycle_timezone, c.value / 4 AS day_strain,
        round(c.value * 21 / CAST(4.184 AS DOUBLE), 6) AS energy_burned,
        CAST(c.user_id % 60 + 100 AS INTEGER) AS max_hr, CAST(c.user_id % 60 + 60 AS INTEGER) AS average_hr,
        CAST(r.user_id % 101 AS DOUBLE) AS recovery_score, CAST(r.user_id % 40 + 40 AS DOUBLE) AS resting_heart_rate,
        r.value / 2 AS heart_rate_variability, r.value / 10 + 30 AS skin_temp,
        CASE WHEN r.event_id IS NOT NULL THEN CAST(96.5 AS DOUBLE) END AS blood_oxygen,
        s.* EXCLUDE (source_sleep_id, nap)
    FROM events c
    LEFT JOIN (SELECT *, CASE WHEN event_id % 3 = 0 THEN -event_id - 1 ELSE event_id END AS cycle_id
               FROM events) r ON c.event_id = r.cycle_id
    LEFT JOIN {SLEEP_SQL} s
        ON CASE WHEN r.event_id % 4 <> 0 THEN CAST(r.event_id AS VARCHAR) END = s.source_sleep_id""")
def model_cycles(t: Tables) -> DataFrame:
    """Cycles with recovery and sleep."""
    cycles = staging.stage_cycles(cycle_records(t.events))
    recoveries = staging.stage_recoveries(recovery_records(t.events))
    joined = intermediate.physiological_cycles(
        cycles, recoveries, intermediate.numbered_sleeps(staging.stage_sleeps(sleep_records(t.events)))
    )
    return joined.withColumn("energy_burned", F.round("energy_burned", 6))


def moon_days(t: Tables) -> DataFrame:
    return staging.moon_calendar_columns(moon_seed(t.spark))


def built_for_checks(t: Tables) -> dict[str, DataFrame]:
    """Models by name, written so that all checks of one read the same rows."""
    sleeps = stage(staging.stage_sleeps(sleep_records(t.events)), "checked")
    workouts = stage(staging.stage_workouts(workout_records(t.events)), "checked")
    return {
        "stg_body_sleep": sleeps,
        "stg_body_workouts": workouts,
        "int_body_sleep": stage(_sleeps(t, sleeps).drop("source_sleep_id"), "checked"),
        "int_body_workouts": stage(_workouts(t, staged=workouts), "checked"),
        "fct_activities": stage(_semantic(t), "checked"),
    }
