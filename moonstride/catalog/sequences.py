"""Running numbers and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.operators.sequence import number_by_time, number_rows, surrogate_keys
from moonstride.operators.summary import members

_GAP_SQL = "(SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS ts FROM events)"


@query("SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS sequence FROM events")
def wn_global_sequence(t: Tables) -> DataFrame:
    """Number all events in time order."""
    return number_rows(t.events.select("event_id", "ts"), ("ts", "event_id"), "sequence")


@query(f"""
    SELECT event_id, ts, row_number() OVER (ORDER BY ts NULLS LAST, event_id) AS sequence,
           row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts NULLS LAST, event_id) AS sequence_of_day
    FROM {_GAP_SQL} e""")
def wn_sequence_of_day(t: Tables) -> DataFrame:
    """Number overall and within the day; a third of the rows has no time."""
    moment = F.when(F.col("event_id") % 3 != 0, F.col("ts"))
    events = t.events.select("event_id", moment.alias("ts"))
    return number_by_time(events, "ts", "event_id", "sequence", "sequence_of_day")


@query("""
    SELECT row_number() OVER (ORDER BY name NULLS LAST, user_id NULLS LAST) AS member_id, name, user_id
    FROM (SELECT DISTINCT CASE WHEN event_type <> 'error' THEN event_type END AS name, user_id FROM events) d""")
def wn_surrogate_key(t: Tables) -> DataFrame:
    """Keys of a distinct set with nulls last."""
    name = F.when(F.col("event_type") != "error", F.col("event_type"))
    pairs = members(t.events.select(name.alias("name"), "user_id"), "name", "user_id")
    return surrogate_keys(pairs, ("name", "user_id"), "member_id")
