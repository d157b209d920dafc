"""Record layouts of the landing files.

Times stay strings here, as the files hold them; staging casts them.
"""

from __future__ import annotations

# Field names and types of the source records.
ACTIVITY = """
    id bigint, name string, type string, sport_type string,
    start_date string, start_date_local string, timezone string,
    distance double, moving_time double, elapsed_time double, total_elevation_gain double,
    average_speed double, max_speed double,
    average_heartrate double, max_heartrate double, average_watts double,
    kilojoules double, average_cadence double,
    achievement_count double, kudos_count double, comment_count double, athlete_count double,
    trainer boolean, commute boolean, manual boolean, private boolean, flagged boolean,
    gear_id string, start_latlng array<double>, end_latlng array<double>
"""

SLEEP = """
    id string, user_id bigint, created_at string, updated_at string,
    start string, end string, timezone_offset string, nap boolean, score_state string,
    score struct<
        stage_summary: struct<
            total_in_bed_time_milli: bigint, total_awake_time_milli: bigint,
            total_light_sleep_time_milli: bigint, total_slow_wave_sleep_time_milli: bigint,
            total_rem_sleep_time_milli: bigint>,
        sleep_needed: struct<
            baseline_milli: bigint, need_from_sleep_debt_milli: bigint,
            need_from_recent_strain_milli: bigint, need_from_recent_nap_milli: bigint>,
        respiratory_rate: double, sleep_performance_percentage: double,
        sleep_consistency_percentage: double, sleep_efficiency_percentage: double>
"""

WORKOUT = """
    id string, user_id bigint, created_at string, updated_at string,
    start string, end string, timezone_offset string,
    sport_id double, sport_name string, score_state string,
    score struct<
        strain: double, average_heart_rate: double, max_heart_rate: double,
        kilojoule: double, percent_recorded: double, distance_meter: double,
        altitude_gain_meter: double, altitude_change_meter: double,
        zone_durations: struct<
            zone_zero_milli: bigint, zone_one_milli: bigint, zone_two_milli: bigint,
            zone_three_milli: bigint, zone_four_milli: bigint, zone_five_milli: bigint>>
"""

CYCLE = """
    id bigint, user_id bigint, created_at string, updated_at string,
    start string, end string, timezone_offset string, score_state string,
    score struct<strain: double, kilojoule: double, average_heart_rate: double, max_heart_rate: double>
"""

RECOVERY = """
    cycle_id bigint, sleep_id string, user_id bigint, created_at string, updated_at string,
    score_state string,
    score struct<
        user_calibrating: boolean, recovery_score: double, resting_heart_rate: double,
        hrv_rmssd_milli: double, spo2_percentage: double, skin_temp_celsius: double>
"""

ACTIVITY_MAPPING = """
    source string, activity_name string, aligned_activity_name string, is_sport_exercise boolean
"""

MOON_CALENDAR = """
    Datum date, Wochentag string, Monat string, Mondphase string,
    Beleuchtung decimal(10,2), Phasenzyklus int
"""
