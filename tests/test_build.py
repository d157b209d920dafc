"""From landing files to tested tables, in one run."""

import json
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moonstride.plans.build import Build, Inputs
from moonstride.plans.checks import run_checks
from moonstride.plans.names import Names
from moonstride.plans.staging import ACTIVITY_COLUMNS, flatten_activities, stage_activities
from moonstride.sources import read_landing
from moonstride.sources import schemas as S
from moonstride.sources.literals import literal_table

HOUR = 3_600_000


def activity(key, start, sport, gear=None, **more):
    return {
        "id": key, "name": f"activity {key}", "type": sport, "sport_type": sport,
        "start_date": start, "start_date_local": start, "timezone": "UTC", "distance": 1005.005,
        "moving_time": 90, "elapsed_time": 3600, "total_elevation_gain": 0.125, "average_speed": 2.5,
        "max_speed": 5, "kudos_count": 3, "trainer": False, "gear_id": gear,
        "start_latlng": [48.1, 11.5], "end_latlng": [], **more,
    }


def sleep(key, start, end, nap):
    stages = {
        "total_in_bed_time_milli": 9 * HOUR, "total_awake_time_milli": HOUR, "total_light_sleep_time_milli": 4 * HOUR,
        "total_slow_wave_sleep_time_milli": 2 * HOUR, "total_rem_sleep_time_milli": 2 * HOUR,
    }
    need = {
        "baseline_milli": 8 * HOUR, "need_from_sleep_debt_milli": HOUR, "need_from_recent_strain_milli": HOUR,
        "need_from_recent_nap_milli": 2 * HOUR,
    }
    score = {
        "stage_summary": stages, "sleep_needed": need, "respiratory_rate": 14.20703125,
        "sleep_performance_percentage": 98, "sleep_consistency_percentage": 90, "sleep_efficiency_percentage": 88.41,
    }
    return {"id": key, "start": start, "end": end, "nap": nap, "score": score}


def workout(key, start, end, sport, percent=100):
    zones = {f"zone_{n}_milli": 60000 for n in ("zero", "one", "two", "three", "four", "five")}
    score = {"strain": 7.5, "average_heart_rate": 118, "max_heart_rate": 151, "kilojoule": 1204.6,
             "percent_recorded": percent, "zone_durations": zones}
    return {"id": key, "start": start, "end": end, "sport_id": 1, "sport_name": sport, "score": score}


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "partitioned"])
def built(spark, tmp_path_factory, request):
    folder = tmp_path_factory.mktemp("landing")
    files = {
        "activities": [
            activity(30, "2024-01-05T10:00:00Z", "Run", "g1"),
            activity(10, "2024-01-02T06:30:00Z", "Ride"),
            activity(20, "2024-01-02T05:30:00+02:00", "Kitesurf", "g2"),
        ],
        "sleeps": [
            sleep("s1", "2024-01-02T23:10:00Z", "2024-01-03T07:00:00Z", False),
            sleep("s2", "2024-01-03T00:30:00Z", "2024-01-03T08:00:00Z", False),
            sleep("s3", "2024-01-03T11:00:00Z", "2024-01-03T11:40:00Z", True),
            {"id": "s4", "start": "2024-01-06T01:00:00Z", "end": "2024-01-06T02:00:00Z", "nap": None},
        ],
        "workouts": [
            workout("w1", "2024-01-04T10:00:59Z", "2024-01-04T10:01:01Z", "hiit"),
            workout("w2", "2024-01-04T09:00:00Z", "2024-01-04T10:00:00Z", "kite", percent=101),
        ],
        "cycles": [{"id": 7, "start": "2024-01-03T00:00:00Z", "score": {"strain": 5.3, "kilojoule": 418.4}}, {"id": 8}],
        "recoveries": [{"cycle_id": 7, "sleep_id": "s2", "score": {"recovery_score": 44}}],
    }
    raw = {}
    for name, layout in zip(files, (S.ACTIVITY, S.SLEEP, S.WORKOUT, S.CYCLE, S.RECOVERY)):
        (folder / f"{name}.json").write_text(json.dumps(files[name], indent=1))
        raw[name] = read_landing(spark, str(folder / f"{name}.json"), layout)
    moon = literal_table(
        spark, S.MOON_CALENDAR, [(f"2024-01-0{d}", "x", "January", "Full Moon", "50.5", d) for d in range(1, 4)]
    )
    names = Names(track="ride", body="band")
    prefix = f"b{uuid.uuid4().hex}_"
    location = str(tmp_path_factory.mktemp("tables"))
    build = Build(spark, names, location, prefix, partition_facts=request.param)
    inputs = Inputs(
        flatten_activities(raw["activities"]), raw["sleeps"], raw["workouts"], moon,
        cycles=raw["cycles"], recoveries=raw["recoveries"],
    )
    models = build.run(inputs, calendar_end=date(2024, 1, 8))
    return spark, models, names, prefix


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(columns[0]).collect()]


def test_activities(built):
    spark, models, _, prefix = built
    fact = spark.table(f"{prefix}ride.fct_ride_activities")
    got = rows(fact, "ride_activity_id", "ride_activity_id_of_day", "name", "ride_activity_type_id", "ride_gear_id")
    # the offset of a start time is dropped, so 20 comes before 10; unmapped sports have no type
    assert got == [
        (1, 1, "activity 20", None, 2),
        (2, 2, "activity 10", 1, 3),
        (3, 1, "activity 30", 2, 1),
    ]
    one = fact.where("ride_activity_id = 3").first()
    assert str(one["distance_meters"]) == "1005.01" and one["distance_kilometers"] == 1005.005 / 1000
    assert (one["moving_time_minutes"], one["elapsed_time_hours"], one["max_speed_kilometers_per_hour"]) == (1.5, 1, 18)
    assert str(one["total_elevation_gain_meters"]) == "0.13"
    assert (one["start_latitude"], one["end_latitude"]) == (48.1, None)
    socials = spark.table(f"{prefix}ride.fct_ride_activities_socials")
    assert socials.count() == 3 and "kudos_count" not in fact.columns and "trainer" in socials.columns
    semantic = rows(spark.table(f"{prefix}semantic.fct_activities"), "ride_activity_id", "activity_name", "is_sport_exercise")
    assert semantic == [(1, None, None), (2, "Cycling", True), (3, "Run", True)]
    assert rows(models["dim_ride_gear"], "ride_gear_id", "gear_id") == [(1, "g1"), (2, "g2"), (3, None)]


def test_sleeps(built):
    spark, models, _, prefix = built
    got = rows(spark.table(f"{prefix}band.fct_band_sleeps"), "sleep_id", "sleep_id_of_day", "date_day", "moon_phase_cycle")
    assert got == [
        (1, 1, date(2024, 1, 2), 2),
        (2, 1, date(2024, 1, 2), 2),
        (3, 2, date(2024, 1, 3), 3),
        (4, 1, date(2024, 1, 6), None),
    ]
    first = models["int_band_sleep"].where("sleep_id = 1").first()
    assert (first["asleep_duration_minutes"], first["asleep_duration_hours"], first["sleep_need_hours"]) == (480, 8, 8)
    assert str(first["respiratory_rate"]) == "14.21" and str(first["sleep_efficiency"]) == "88.41"
    quality = spark.table(f"{prefix}band.fct_band_sleep_quality")
    assert "nap" in quality.columns and not [c for c in quality.columns if "duration" in c]
    unscored = models["int_band_sleep"].where("sleep_id = 4").first()
    assert unscored["asleep_duration_minutes"] is None and unscored["sleep_performance"] is None


def test_workouts_and_cycles(built):
    spark, models, _, prefix = built
    facts = spark.table(f"{prefix}band.fct_band_workouts")
    got = rows(facts, "band_workout_id", "band_workout_id_of_day", "duration_minutes", "activity_name")
    assert got == [(1, 1, 60, None), (2, 2, 1, "HIIT")]
    assert facts.first()["zone_five_milli"] == 60000
    assert rows(models["dim_band_workouts"], "band_workout_activity_name_id", "activity_name") == [(1, "HIIT"), (2, None)]
    cycles = rows(models["fct_band_physiological_cycles"], "cycle_id", "sleep_id", "recovery_score", "cycle_end_time")
    assert cycles == [(7, 2, 44.0, None), (8, None, None, None)]
    burned = models["fct_band_physiological_cycles"].where("cycle_id = 7").first()["energy_burned"]
    assert burned == pytest.approx(100)


def test_calendar_and_data_check(built):
    spark, models, _, prefix = built
    assert spark.table(f"{prefix}dates.dim_dates").count() == 6
    flags = spark.table(f"{prefix}semantic.data_check").orderBy("date_day").collect()
    assert [tuple(r)[3:] for r in flags] == [
        (True, False, True),
        (True, False, False),
        (False, True, False),
        (False, False, True),
        (True, False, False),
        (False, False, False),
    ]


def test_declared_checks(built):
    _, models, names, _ = built
    found = run_checks(models, names, as_of=date(2024, 1, 6)).where("violations > 0").collect()
    assert {(r["table_name"], r["column_name"], r["check_name"], r["violations"]) for r in found} == {
        ("stg_ride_activities", "type", "accepted_values", 1),
        ("stg_band_sleep", "sleep_performance", "not_null", 1),
        ("stg_band_sleep", "respiratory_rate", "not_null", 1),
        ("stg_band_workouts", "source_activity_name", "accepted_values", 1),
        ("stg_band_workouts", "percent_recorded", "at_most", 1),
        ("int_band_sleep", "date_day", "relationships", 1),
        ("fct_activities", "activity_name", "not_null", 1),
        ("fct_band_physiological_cycles", "cycle_start_time", "not_null", 1),
        ("fct_band_physiological_cycles", "cycle_end_time", "not_null", 2),
        ("fct_band_physiological_cycles", "cycle_timezone", "not_null", 2),
        ("fct_band_physiological_cycles", "sleep_onset", "not_null", 1),
        ("fct_band_physiological_cycles", "wake_onset", "not_null", 1),
        ("fct_band_physiological_cycles", "sleep_performance", "not_null", 1),
        ("fct_band_physiological_cycles", "respiratory_rate", "not_null", 1),
        ("dim_dates", "date_day", "calendar_horizon", 1),
    }
    severity = {r["check_name"]: r["severity"] for r in found}
    assert severity["calendar_horizon"] == "warn"


def test_staged_activities_keep_to_their_contract(spark):
    raw = spark.createDataFrame(
        [(1, "far", "7.6", "x", True), (2, "3.5", None, "y", None)], "activity_id int, distance string, moving_time string, extra string, trainer boolean"
    )
    fields = T.StructType.fromDDL(ACTIVITY_COLUMNS).fields
    raw = raw.withColumns({f.name: F.lit(None).cast("string") for f in fields if f.name not in raw.columns})
    staged = stage_activities(raw)
    assert [(f.name, f.dataType) for f in staged.schema.fields] == [(f.name, f.dataType) for f in fields]
    got = staged.select("activity_id", "distance", "moving_time").orderBy("activity_id").collect()
    assert [tuple(r) for r in got] == [(1, None, 8), (2, 3.5, None)]
