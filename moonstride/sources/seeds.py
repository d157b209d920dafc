"""CSV seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moonstride.sources.literals import literal_table
from moonstride.sources.schemas import ACTIVITY_MAPPING, MOON_CALENDAR

# Names of activities at the trackers, their common name, and whether it counts as sport.
ACTIVITY_NAMES = """activity_name,aligned_activity_name,is_sport_exercise
activity,Activity,false
badminton,Badminton,true
commuting,Commuting,false
cycling,Cycling,true
dance,Dance,false
dog-walking,Dog-walking,false
hiit,HIIT,true
hiking-rucking,Hiking,true
increase_relaxation,Breath Work,false
padel,Padel,true
powerlifting,WeightTraining,true
running,Run,true
sauna,Sauna,false
sculpt-yoga,Yoga,true
ski-touring,Nordic Ski,true
swimming,Swim,true
table-tennis,Table Tennis,false
walking,Commuting,false
weightlifting,WeightTraining,true
yoga,Yoga,true
Ride,Cycling,true
Racquetball,Badminton,true
NordicSki,Nordic Ski,true
Workout,WeightTraining,true
WeightTraining,WeightTraining,true
HighIntensityIntervalTraining,HIIT,true
Crossfit,WeightTraining,true
Hike,Hiking,true
Yoga,Yoga,true
Run,Run,true
Swim,Swim,true
"""


def _read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    # the default line separator accepts both LF and CRLF
    return spark.read.schema(schema).option("header", True).csv(path)


def read_activity_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Seed of activity names; see ``plans.staging.stage_activity_mapping``."""
    return _read_csv(spark, path, ACTIVITY_MAPPING)


def default_activity_mapping(spark: SparkSession) -> DataFrame:
    """The built-in mapping, for use without a seed file; it does not say which tracker uses a name."""
    header, *lines = ACTIVITY_NAMES.strip().splitlines()
    *names, flag = header.split(",")
    rows = [(*line.split(",")[:2], line.endswith(",true")) for line in lines]
    return literal_table(spark, ", ".join(f"{n} string" for n in names) + f", {flag} boolean", rows)


def read_moon_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Seed of moon phases per day, with its original column names."""
    return _read_csv(spark, path, MOON_CALENDAR)


def moon_calendar_columns(seed: DataFrame) -> DataFrame:
    """Moon calendar under the names the models use."""
    return seed.select(
        F.col("Datum").cast("date").alias("date_day"),
        F.col("Wochentag").alias("day_of_week"),
        F.col("Monat").alias("month"),
        F.col("Mondphase").alias("moon_phase"),
        F.col("Beleuchtung").cast("decimal(10,2)").alias("illumination"),
        F.col("Phasenzyklus").cast("int").alias("phase_cycle"),
    )
