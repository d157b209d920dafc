"""Joins with lookups and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.catalog.standins import MAPPING_SQL, MOON_SQL, mapping_seed, moon_seed
from moonstride.functions.times import day_of
from moonstride.operators.lookups import foreign_key, left_lookup, without_match
from moonstride.operators.sequence import surrogate_keys
from moonstride.operators.summary import members
from moonstride.plans.staging import moon_calendar_columns, stage_activity_mapping

_KIND = ("event_type", "activity_name", "is_sport_exercise")
_NAMED_SQL = f"""(
    SELECT e.event_id, e.event_type, e.ts, m.aligned_activity_name AS activity_name, m.is_sport_exercise,
           CASE WHEN e.user_id % 10 <> 0 THEN 'g' || (e.user_id % 10) END AS gear
    FROM events e LEFT JOIN {MAPPING_SQL} m ON e.event_type = m.original_activity_name)"""
_KIND_SQL = f"""(
    SELECT row_number() OVER (ORDER BY event_type, activity_name, is_sport_exercise) AS kind_id, *
    FROM (SELECT DISTINCT event_type, activity_name, is_sport_exercise FROM {_NAMED_SQL} n
          WHERE activity_name IS NOT NULL) d)"""


def named_events(t: Tables) -> DataFrame:
    """Events with common name, sport flag and a gear that may be missing."""
    gear = F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("g"), (F.col("user_id") % 10).cast("string")))
    events = t.events.select("event_id", "event_type", "ts", gear.alias("gear"))
    mapping = stage_activity_mapping(mapping_seed(t.spark))
    named = left_lookup(events, mapping, "event_type", "original_activity_name")
    return named.withColumnRenamed("aligned_activity_name", "activity_name")


def kinds(named: DataFrame) -> DataFrame:
    known = members(named.where(F.col("activity_name").isNotNull()), *_KIND)
    return surrogate_keys(known, _KIND, "kind_id")


@query(f"SELECT event_id, event_type, activity_name, is_sport_exercise FROM {_NAMED_SQL} n")
def jn_left_lookup(t: Tables) -> DataFrame:
    """Events with the name of their type; one type has none."""
    return named_events(t).select("event_id", *_KIND)


@query(f"""
    SELECT e.event_id, CAST(e.ts AS DATE) AS date_day, m.moon_phase, m.illumination
    FROM events e LEFT JOIN {MOON_SQL} m ON CAST(e.ts AS DATE) = m.date_day""")
def jn_left_date(t: Tables) -> DataFrame:
    """Events with the moon of their day; two days have none."""
    days = moon_calendar_columns(moon_seed(t.spark)).select("date_day", "moon_phase", "illumination")
    events = t.events.select("event_id", day_of(F.col("ts")).alias("date_day"))
    return left_lookup(events, days, "date_day", "date_day")


@query(f"""
    SELECT n.event_id, k.kind_id FROM {_NAMED_SQL} n
    LEFT JOIN {_KIND_SQL} k ON n.event_type = k.event_type AND n.activity_name = k.activity_name
        AND n.is_sport_exercise = k.is_sport_exercise""")
def jn_left_composite(t: Tables) -> DataFrame:
    """Foreign key over three natural keys; a null among them gives a null key."""
    named = named_events(t)
    return foreign_key(named, kinds(named), _KIND, "kind_id").select("event_id", "kind_id")


@query(f"""
    SELECT n.event_id, n.gear, g.gear_id FROM {_NAMED_SQL} n
    LEFT JOIN (SELECT row_number() OVER (ORDER BY gear NULLS LAST) AS gear_id, gear
               FROM (SELECT DISTINCT gear FROM {_NAMED_SQL} d) x) g ON n.gear IS NOT DISTINCT FROM g.gear""")
def jn_null_safe(t: Tables) -> DataFrame:
    """Foreign key of a nullable natural key; null has a member of its own."""
    events = named_events(t).select("event_id", "gear")
    gears = surrogate_keys(members(events, "gear"), ("gear",), "gear_id")
    return foreign_key(events, gears, ("gear",), "gear_id", null_safe=True)


@query(f"""
    SELECT n.event_id, k.kind_id, k.activity_name, k.is_sport_exercise FROM {_NAMED_SQL} n
    LEFT JOIN {_KIND_SQL} k ON n.event_type = k.event_type AND n.activity_name = k.activity_name
        AND n.is_sport_exercise = k.is_sport_exercise""")
def jn_star(t: Tables) -> DataFrame:
    """A fact of keys, joined with its dimension on the surrogate key."""
    named = named_events(t)
    dimension = kinds(named)
    fact = foreign_key(named, dimension, _KIND, "kind_id").select("event_id", "kind_id")
    return fact.join(dimension.drop("event_type"), "kind_id", "left")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jn_left_anti(t: Tables) -> DataFrame:
    """Documents without a label."""
    return without_match(t.documents.select("doc_id", "source"), t.labels, "doc_id", "doc_id")
