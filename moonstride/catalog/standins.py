"""Records of the reference's kinds, derived from the test tables.

Each stand-in is a DataFrame expression and, for the SQL side, a subquery over the same
table. Ids modulo small numbers only decide flags and gaps; no row is left out.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moonstride.sources.literals import literal_table
from moonstride.sources.schemas import ACTIVITY_MAPPING, MOON_CALENDAR

AS_OF = date(2024, 1, 20)

# event type, common name, sport flag; "error" is left unmapped
MAPPING_ROWS = [
    ("track", "view", "Run", True),
    ("track", "click", "Run", True),
    ("track", "signup", "Cycling", True),
    ("track", "purchase", "Commuting", False),
]

# The phases in the order the dashboard shows them.
MOON_PHASES = (
    "New Moon", "Waxing Crescent", "First Quarter", "Waxing Gibbous",
    "Full Moon", "Waning Gibbous", "Last Quarter", "Waning Crescent",
)

# January 2024 without two days; every second phase name is written differently
MOON_ROWS = [
    (
        date(2024, 1, d).isoformat(),
        date(2024, 1, d).strftime("%A"),
        "January",
        MOON_PHASES[d % 8] if d % 2 else f" {MOON_PHASES[d % 8].upper()} ",
        f"{d * 3.3:.2f}",
        d % 8,
    )
    for d in range(1, 31)
    if d not in (13, 26)
]


def _sql_value(value) -> str:
    if isinstance(value, bool | int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def sql_rows(rows, *columns: str) -> str:
    """Rows as an SQL subquery."""
    values = ", ".join("(" + ", ".join(map(_sql_value, row)) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {values}) v({', '.join(columns)}))"


MAPPING_SQL = sql_rows(
    MAPPING_ROWS, "source", "original_activity_name", "aligned_activity_name", "is_sport_exercise"
)
MOON_SQL = f"""(
    SELECT CAST(d AS DATE) AS date_day, weekday AS day_of_week, month, moon_phase,
           CAST(lit AS DECIMAL(10,2)) AS illumination, CAST(cycle AS INTEGER) AS phase_cycle
    FROM {sql_rows(MOON_ROWS, "d", "weekday", "month", "moon_phase", "lit", "cycle")} m)"""


def mapping_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ACTIVITY_MAPPING, MAPPING_ROWS)


def moon_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MOON_CALENDAR, MOON_ROWS)


def shifted(moment: str, micros) -> F.Column:
    """A moment moved by a number of microseconds, still without zone."""
    return F.timestamp_add("MICROSECOND", micros, F.col(moment))


def activity_records(events: DataFrame) -> DataFrame:
    """Nested activity records with times as text."""
    value, user, event = F.col("value"), F.col("user_id"), F.col("event_id")
    return events.select(
        event.alias("id"),
        F.concat(F.lit("Event "), event.cast("string")).alias("name"),
        F.col("event_type").alias("type"),
        F.col("event_type").alias("sport_type"),
        F.col("ts").cast("string").alias("start_date"),
        F.concat(F.col("ts").cast("string"), F.lit("+02:00")).alias("start_date_local"),
        F.lit("UTC").alias("timezone"),
        (value * 100).alias("distance"),
        value.alias("moving_time"),
        (value * 2).alias("elapsed_time"),
        (value / 3).alias("total_elevation_gain"),
        (value / 7).alias("average_speed"),
        (value / 5).alias("max_speed"),
        (user % 50 + 100).cast("double").alias("average_heartrate"),
        (user % 50 + 120).cast("double").alias("max_heartrate"),
        F.when(event % 4 != 0, value * 3).alias("average_watts"),
        (value * 11).alias("kilojoules"),
        F.lit(None).cast("double").alias("average_cadence"),
        (user % 3).cast("double").alias("achievement_count"),
        (user % 5).cast("double").alias("kudos_count"),
        (user % 2).cast("double").alias("comment_count"),
        F.lit(1.0).alias("athlete_count"),
        (event % 2 == 0).alias("trainer"),
        (event % 3 == 0).alias("commute"),
        F.lit(False).alias("manual"),
        F.lit(False).alias("private"),
        (event % 5 == 0).alias("flagged"),
        F.when(user % 10 != 0, F.concat(F.lit("g"), (user % 10).cast("string"))).alias("gear_id"),
        F.array(value, -value).alias("start_latlng"),
        F.when(event % 3 == 0, F.array().cast("array<double>"))
        .when(event % 3 == 1, F.array(value / 2, value / 4))
        .alias("end_latlng"),
    )


FLAT_ACTIVITY_SQL = """(
    SELECT event_id AS activity_id, 'Event ' || event_id AS name, event_type AS type,
        event_type AS sport_type, CAST(ts AS VARCHAR) AS start_date,
        CAST(ts AS VARCHAR) || '+02:00' AS start_date_local, 'UTC' AS timezone,
        value * 100 AS distance, value AS moving_time, value * 2 AS elapsed_time,
        value / 3 AS total_elevation_gain, value / 7 AS average_speed, value / 5 AS max_speed,
        CAST(user_id % 50 + 100 AS DOUBLE) AS average_heartrate,
        CAST(user_id % 50 + 120 AS DOUBLE) AS max_heartrate,
        CASE WHEN event_id % 4 <> 0 THEN value * 3 END AS average_watts,
        value * 11 AS kilojoules, CAST(NULL AS DOUBLE) AS average_cadence,
        CAST(user_id % 3 AS DOUBLE) AS achievement_count, CAST(user_id % 5 AS DOUBLE) AS kudos_count,
        CAST(user_id % 2 AS DOUBLE) AS comment_count, CAST(1 AS DOUBLE) AS athlete_count,
        event_id % 2 = 0 AS trainer, event_id % 3 = 0 AS commute, false AS manual, false AS private,
        event_id % 5 = 0 AS flagged,
        CASE WHEN user_id % 10 <> 0 THEN 'g' || (user_id % 10) END AS gear_id,
        value AS start_latitude, -value AS start_longitude,
        CASE WHEN event_id % 3 = 1 THEN value / 2 END AS end_latitude,
        CASE WHEN event_id % 3 = 1 THEN value / 4 END AS end_longitude
    FROM events)"""

# activities numbered, converted and mapped, as plain SQL states it
ACTIVITY_SQL = f"""(
    SELECT a.activity_id AS track_activity_id_internal,
        row_number() OVER (ORDER BY a.start_at) AS track_activity_id,
        row_number() OVER (PARTITION BY CAST(a.start_at AS DATE) ORDER BY a.start_at)
            AS track_activity_id_of_day,
        a.name, a.type, CAST(a.start_at AS DATE) AS date_day, a.start_at AS start_date,
        a.start_at AS start_date_local, a.timezone,
        CAST(distance AS DECIMAL(10,2)) AS distance_meters, distance / 1000 AS distance_kilometers,
        CAST(moving AS DECIMAL(10,2)) AS moving_time_seconds, moving / 60 AS moving_time_minutes,
        moving / 3600 AS moving_time_hours,
        CAST(elapsed AS DECIMAL(10,2)) AS elapsed_time_seconds, elapsed / 60 AS elapsed_time_minutes,
        elapsed / 3600 AS elapsed_time_hours,
        CAST(total_elevation_gain AS DECIMAL(10,2)) AS total_elevation_gain_meters,
        CAST(average_speed AS DECIMAL(10,2)) AS average_speed_meters_per_second,
        average_speed * CAST(3.6 AS DOUBLE) AS average_speed_kilometers_per_hour,
        CAST(max_speed AS DECIMAL(10,2)) AS max_speed_meters_per_second,
        max_speed * CAST(3.6 AS DOUBLE) AS max_speed_kilometers_per_hour,
        start_latitude, start_longitude, end_latitude, end_longitude,
        average_heartrate, max_heartrate, average_watts, kilojoules, average_cadence,
        CAST(achievement_count AS INTEGER) AS achievement_count, CAST(kudos_count AS INTEGER) AS kudos_count,
        CAST(comment_count AS INTEGER) AS comment_count, CAST(athlete_count AS INTEGER) AS athlete_count,
        trainer, commute, manual, private, flagged, gear_id,
        m.aligned_activity_name AS activity_name, m.is_sport_exercise AS is_sport_exercise
    FROM (SELECT *, CAST(start_date AS TIMESTAMP) AS start_at, CAST(moving_time AS INTEGER) AS moving,
                 CAST(elapsed_time AS INTEGER) AS elapsed FROM {FLAT_ACTIVITY_SQL} f) a
    LEFT JOIN {MAPPING_SQL} m ON a.sport_type = m.original_activity_name)"""

TYPE_SQL = f"""(
    SELECT row_number() OVER (ORDER BY type, activity_name, is_sport_exercise) AS track_activity_type_id, *
    FROM (SELECT DISTINCT type, activity_name, is_sport_exercise FROM {ACTIVITY_SQL} a
          WHERE type IS NOT NULL AND activity_name IS NOT NULL) t)"""

GEAR_SQL = f"""(
    SELECT row_number() OVER (ORDER BY gear_id NULLS LAST) AS track_gear_id, gear_id
    FROM (SELECT DISTINCT gear_id FROM {ACTIVITY_SQL} a) g)"""

KEYED_ACTIVITY_SQL = f"""(
    SELECT a.*, t.track_activity_type_id, g.track_gear_id
    FROM {ACTIVITY_SQL} a
    LEFT JOIN {TYPE_SQL} t ON a.type = t.type AND a.activity_name = t.activity_name
        AND a.is_sport_exercise = t.is_sport_exercise
    LEFT JOIN {GEAR_SQL} g ON a.gear_id IS NOT DISTINCT FROM g.gear_id)"""


def sleep_records(events: DataFrame) -> DataFrame:
    """Nested sleep records; some naps are unknown and some scores are missing."""
    event, user = F.col("event_id"), F.col("user_id")
    k, light = F.col("_k"), F.col("_light")
    # parsed once, in a projection of its own
    events = events.withColumns(
        {
            "_k": F.from_json("props", "k bigint")["k"],
            "_light": F.round(F.col("value") * 60000).cast("bigint"),
        }
    )
    score = F.struct(
        F.struct(
            (light + k * 1700).alias("total_in_bed_time_milli"),
            (k * 700).alias("total_awake_time_milli"),
            light.alias("total_light_sleep_time_milli"),
            (k * 1000).alias("total_slow_wave_sleep_time_milli"),
            (user * 500).alias("total_rem_sleep_time_milli"),
        ).alias("stage_summary"),
        F.struct(
            F.lit(27000000).cast("bigint").alias("baseline_milli"),
            (k * 60).alias("need_from_sleep_debt_milli"),
            (user * 7).alias("need_from_recent_strain_milli"),
            (event % 5 * 1000).alias("need_from_recent_nap_milli"),
        ).alias("sleep_needed"),
        (F.col("value") / 3).alias("respiratory_rate"),
        (k / 7).alias("sleep_performance_percentage"),
        (k / 9).alias("sleep_consistency_percentage"),
        (k / 11).alias("sleep_efficiency_percentage"),
    )
    return events.select(
        event.cast("string").alias("id"),
        F.col("ts").cast("string").alias("start"),
        shifted("ts", light * 1000).cast("string").alias("end"),
        F.when(event % 11 != 0, event % 7 == 0).alias("nap"),
        F.when(event % 13 != 0, score).alias("score"),
    )


STAGED_SLEEP_SQL = """(
    SELECT CAST(event_id AS VARCHAR) AS sleep_id, ts AS sleep_onset,
        ts + to_microseconds(light * 1000) AS wake_onset,
        CAST(s * k / CAST(7 AS DOUBLE) AS DECIMAL(10,2)) AS sleep_performance,
        CAST(s * value / 3 AS DECIMAL(10,2)) AS respiratory_rate,
        s * (light + k * 1000 + user_id * 500) / CAST(60000 AS DOUBLE) AS asleep_duration,
        s * (light + k * 1700) / CAST(60000 AS DOUBLE) AS in_bed_duration,
        s * light / CAST(60000 AS DOUBLE) AS light_sleep_duration,
        s * k * 1000 / CAST(60000 AS DOUBLE) AS deep_sleep_duration,
        s * user_id * 500 / CAST(60000 AS DOUBLE) AS rem_duration,
        s * k * 700 / CAST(60000 AS DOUBLE) AS awake_duration,
        s * (27000000 + k * 60 + user_id * 7 - event_id % 5 * 1000) / CAST(60000 AS DOUBLE) AS sleep_need,
        s * k * 60 / CAST(60000 AS DOUBLE) AS sleep_debt,
        CAST(s * k / CAST(11 AS DOUBLE) AS DECIMAL(10,2)) AS sleep_efficiency,
        CAST(s * k / CAST(9 AS DOUBLE) AS DECIMAL(10,2)) AS sleep_consistency,
        CASE WHEN event_id % 11 <> 0 THEN event_id % 7 = 0 END AS nap
    FROM (SELECT *, CASE WHEN event_id % 13 <> 0 THEN 1 END AS s,
                 CAST(round(value * 60000) AS BIGINT) AS light,
                 CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events) e)"""

SLEEP_SQL = f"""(
    SELECT row_number() OVER (ORDER BY sleep_onset) AS sleep_id,
        row_number() OVER (PARTITION BY date_trunc('day', sleep_onset) ORDER BY sleep_onset)
            AS sleep_id_of_day,
        CASE WHEN extract(hour FROM sleep_onset) < 12 AND nap IS FALSE
             THEN CAST(CAST(sleep_onset AS DATE) - INTERVAL '1 day' AS DATE)
             ELSE CAST(sleep_onset AS DATE) END AS date_day,
        CAST(sleep_onset AS DATE) AS sleep_start_date, sleep_onset,
        CAST(wake_onset AS DATE) AS wake_up_date, wake_onset,
        {", ".join(f"{c} AS {c}_minutes, {c} / 60 AS {c}_hours" for c in (
            "asleep_duration", "in_bed_duration", "light_sleep_duration",
            "deep_sleep_duration", "rem_duration", "awake_duration", "sleep_need", "sleep_debt"))},
        sleep_performance, respiratory_rate, sleep_efficiency, sleep_consistency, nap,
        sleep_id AS source_sleep_id
    FROM {STAGED_SLEEP_SQL} s)"""

NIGHT_SQL = f"""(
    SELECT s.*, m.moon_phase, m.illumination AS moon_illumination, m.phase_cycle AS moon_phase_cycle
    FROM {SLEEP_SQL} s LEFT JOIN {MOON_SQL} m ON s.date_day = m.date_day)"""


def workout_records(events: DataFrame) -> DataFrame:
    """Nested workout records."""
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    names = ("zero", "one", "two", "three", "four", "five")
    zones = [(user * (i + 1) * 100).alias(f"zone_{name}_milli") for i, name in enumerate(names)]
    score = F.struct(
        (value / 9).alias("strain"),
        (user % 60 + 90.5).alias("average_heart_rate"),
        (user % 60 + 120.5).alias("max_heart_rate"),
        (value * 13).alias("kilojoule"),
        (event % 101).cast("double").alias("percent_recorded"),
        F.when(event % 6 != 0, value * 70).alias("distance_meter"),
        (value / 2).alias("altitude_gain_meter"),
        (-value / 2).alias("altitude_change_meter"),
        F.struct(*zones).alias("zone_durations"),
    )
    return events.select(
        event.cast("string").alias("id"),
        F.col("ts").cast("string").alias("start"),
        shifted("ts", F.round(value * 60000000).cast("bigint")).cast("string").alias("end"),
        (user % 9).cast("double").alias("sport_id"),
        F.col("event_type").alias("sport_name"),
        F.when(event % 17 != 0, score).alias("score"),
    )


WORKOUT_SQL = f"""(
    SELECT row_number() OVER (ORDER BY ts) AS body_workout_id,
        row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts) AS body_workout_id_of_day,
        CAST(ts AS DATE) AS date_day, ts AS workout_start_time, ended AS workout_end_time,
        date_diff('minute', ts, ended) AS duration_minutes,
        m.aligned_activity_name AS activity_name, m.is_sport_exercise AS is_sport_exercise,
        s * value / 9 AS activity_strain,
        CAST(s * (user_id % 60 + 90.5) AS DOUBLE)::INTEGER AS average_heart_rate,
        CAST(s * (user_id % 60 + 120.5) AS DOUBLE)::INTEGER AS max_heart_rate,
        s * value * 13 AS kilojoule, CAST(s * (event_id % 101) AS DOUBLE) AS percent_recorded,
        CASE WHEN event_id % 6 <> 0 THEN s * value * 70 END AS distance_meter,
        s * value / 2 AS altitude_gain_meter, s * -value / 2 AS altitude_change_meter,
        {", ".join(f"CAST(s * user_id * {i + 1} * 100 AS BIGINT) AS zone_{n}_milli" for i, n in enumerate(
            ("zero", "one", "two", "three", "four", "five")))}
    FROM (SELECT *, CASE WHEN event_id % 17 <> 0 THEN 1 END AS s,
                 ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS ended FROM events) e
    LEFT JOIN {MAPPING_SQL} m ON e.event_type = m.original_activity_name)"""


def cycle_records(events: DataFrame) -> DataFrame:
    """Cycle records; some are still open."""
    event, value = F.col("event_id"), F.col("value")
    score = F.struct(
        (value / 4).alias("strain"),
        (value * 21).alias("kilojoule"),
        (F.col("user_id") % 60 + 60).cast("double").alias("average_heart_rate"),
        (F.col("user_id") % 60 + 100).cast("double").alias("max_heart_rate"),
    )
    return events.select(
        event.alias("id"),
        F.col("ts").cast("string").alias("start"),
        F.when(event % 9 != 0, shifted("ts", F.lit(86400000000))).cast("string").alias("end"),
        F.lit("-05:00").alias("timezone_offset"),
        score.alias("score"),
    )


def recovery_records(events: DataFrame) -> DataFrame:
    """A recovery for two of three cycles; some point to no known sleep."""
    event, user = F.col("event_id"), F.col("user_id")
    score = F.struct(
        (user % 101).cast("double").alias("recovery_score"),
        (user % 40 + 40).cast("double").alias("resting_heart_rate"),
        (F.col("value") / 2).alias("hrv_rmssd_milli"),
        F.lit(96.5).alias("spo2_percentage"),
        (F.col("value") / 10 + 30).alias("skin_temp_celsius"),
    )
    cycle = F.when(event % 3 == 0, -event - 1).otherwise(event)
    sleep = F.when(event % 4 != 0, event.cast("string")).otherwise(F.concat(F.lit("gone-"), event.cast("string")))
    return events.select(cycle.alias("cycle_id"), sleep.alias("sleep_id"), score.alias("score"))
