"""Row filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.catalog.standins import AS_OF, NIGHT_SQL, moon_seed, sleep_records
from moonstride.functions.text import same_text
from moonstride.operators import filters
from moonstride.operators.sequence import nth_of_day
from moonstride.operators.summary import latest
from moonstride.plans import intermediate, marts, staging


@query(f"""
    SELECT date_day, asleep_duration_minutes, light_sleep_duration_minutes, deep_sleep_duration_minutes,
           rem_duration_minutes, awake_duration_minutes, in_bed_duration_minutes, moon_phase
    FROM {NIGHT_SQL} n WHERE asleep_duration_minutes IS NOT NULL AND moon_phase IS NOT NULL""")
def fl_not_null(t: Tables) -> DataFrame:
    """The dashboard's feed: sleeps with a duration and a moon phase."""
    staged = staging.stage_sleeps(sleep_records(t.events))
    return marts.dashboard_feed(intermediate.nights(staged, staging.moon_calendar_columns(moon_seed(t.spark))))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def fl_category(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= DATE '1998-12-01' AND o_orderdate < DATE '1999-01-01'""")
def fl_month_of_year(t: Tables) -> DataFrame:
    """December, which ends with the year."""
    rows = t.orders.where(filters.in_month_of_year("o_orderdate", 1998, 12))
    return rows.select("o_orderkey", "o_orderdate")


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'""")
def fl_year(t: Tables) -> DataFrame:
    return t.orders.where(filters.in_year("o_orderdate", 1997)).select("o_orderkey", "o_orderdate")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE extract(month FROM o_orderdate) IN (3, 4)")
def fl_month_any_year(t: Tables) -> DataFrame:
    return t.orders.where(filters.in_months("o_orderdate", 3, 4)).select("o_orderkey", "o_orderdate")


@query(f"SELECT event_id, ts FROM events WHERE ts >= DATE '{AS_OF}' - INTERVAL '7 days'")
def fl_last_n_days(t: Tables) -> DataFrame:
    return t.events.where(filters.in_last_days("ts", 7, AS_OF)).select("event_id", "ts")


@query(f"""
    SELECT event_id, ts >= date_trunc('month', DATE '{AS_OF}')
                 AND ts < date_trunc('month', DATE '{AS_OF}') + INTERVAL '1 month' AS this_month
    FROM events
    WHERE ts >= date_trunc('year', DATE '{AS_OF}') AND ts < date_trunc('year', DATE '{AS_OF}') + INTERVAL '1 year'
    """)
def fl_this_period(t: Tables) -> DataFrame:
    """Rows of this year, marked if of this month."""
    rows = t.events.where(filters.in_this_year("ts", AS_OF))
    return rows.select("event_id", filters.in_this_month("ts", AS_OF).alias("this_month"))


@query("""
    WITH moved AS (SELECT event_id, CAST(current_date - CAST(event_id % 400 AS INTEGER) AS DATE) AS day FROM events)
    SELECT event_id, day >= current_date - 7 AS last_days, date_trunc('month', day) = date_trunc('month', current_date) AS this_month,
           year(day) = year(current_date) AS this_year FROM moved""")
def sf_current_date(t: Tables) -> DataFrame:
    """Periods that end today, over events moved to the days before today."""
    day = F.date_sub(F.current_date(), F.pmod(F.col("event_id"), F.lit(400)).cast("int")).alias("day")
    moved = t.events.select("event_id", day)
    return moved.select(
        "event_id", filters.in_last_days("day", 7).alias("last_days"), filters.in_this_month("day").alias("this_month"),
        filters.in_this_year("day").alias("this_year"),
    )


@query("SELECT c_custkey, c_name FROM customer WHERE lower(trim(' ' || c_mktsegment)) = 'building'")
def fl_trim_casefold(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("c_mktsegment"))
    return t.customer.where(same_text(padded, F.lit("Building "))).select("c_custkey", "c_name")


@query("""
    SELECT date_day, event_id, ts, event_type FROM (
        SELECT CAST(ts AS DATE) AS date_day, event_id, ts, event_type,
               row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS n FROM events) e
    WHERE n = 1""")
def fl_first_of_day(t: Tables) -> DataFrame:
    """The first event of every day."""
    return nth_of_day(t.events.select("event_id", "ts", "event_type"), "ts", "event_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = DATE '1995-06-19'")
def fl_on_date(t: Tables) -> DataFrame:
    day = filters.on_date("o_orderdate", date(1995, 6, 19))
    return t.orders.where(day).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def so_latest_n(t: Tables) -> DataFrame:
    """The 50 newest orders."""
    return latest(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", "o_orderkey", 50)
