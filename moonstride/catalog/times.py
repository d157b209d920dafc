"""Date functions and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.catalog.standins import shifted
from moonstride.functions.times import day_of, minutes_crossed, weekday_number
from moonstride.operators.calendar import calendar_from
from moonstride.operators.lookups import existence_flags

CALENDAR_END = date(2024, 2, 1)

CALENDAR_SQL = f"""(
    SELECT CAST(d AS DATE) AS date_day, date_part('year', d) AS year, date_part('month', d) AS month,
        date_part('week', d) AS week, date_part('day', d) AS day,
        strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name, strftime(d, '%w') AS weekday_number,
        strftime(d, '%w') IN ('1', '2', '3', '4', '5') AS is_weekday,
        strftime(d, '%w') IN ('0', '6') AS is_weekend,
        row_number() OVER (PARTITION BY date_part('year', d) ORDER BY d) AS day_of_year
    FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
                 TIMESTAMP '{CALENDAR_END}' - INTERVAL '1 day', INTERVAL '1 day')) AS d) s)"""


@query(f"SELECT * FROM {CALENDAR_SQL} c")
def gn_calendar(t: Tables) -> DataFrame:
    """A row per day from the first order to a fixed end."""
    return calendar_from(t.orders, "o_orderdate", CALENDAR_END)


@query(f"""
    SELECT c.date_day, c.day_name, c.is_weekend,
        EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = c.date_day) AS has_orders,
        EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_shipdate AS DATE) = c.date_day) AS has_shipments,
        EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = c.date_day) AS has_events
    FROM {CALENDAR_SQL} c""")
def jn_existence_flags(t: Tables) -> DataFrame:
    """Per calendar day: is there an order, a shipment, an event?"""
    days = calendar_from(t.orders, "o_orderdate", CALENDAR_END).select("date_day", "day_name", "is_weekend")
    sources = {
        "has_orders": (t.orders.select(day_of(F.col("o_orderdate")).alias("d")), "d"),
        "has_shipments": (t.lineitem.select(day_of(F.col("l_shipdate")).alias("d")), "d"),
        "has_events": (t.events.select(day_of(F.col("ts")).alias("d")), "d"),
    }
    return existence_flags(days, "date_day", sources)


@query("""
    SELECT o_orderkey, CAST(date_trunc('day', o_orderdate) AS DATE) AS day,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
        CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
        date_part('year', o_orderdate) AS year, date_part('month', o_orderdate) AS month,
        date_part('week', o_orderdate) AS week, date_part('day', o_orderdate) AS day_of_month,
        strftime(o_orderdate, '%A') AS day_name, strftime(o_orderdate, '%B') AS month_name,
        strftime(o_orderdate, '%w') AS weekday_number,
        CAST(o_orderdate - INTERVAL '1 day' AS DATE) AS day_before,
        CAST(o_orderdate + INTERVAL '4 years' AS DATE) AS four_years_on
    FROM orders""")
def sf_date_parts(t: Tables) -> DataFrame:
    """Truncation, parts, names and shifts of dates."""
    moment, day = F.col("o_orderdate"), day_of(F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        day.alias("day"),
        F.trunc(day, "MM").alias("month_start"),
        F.trunc(day, "YYYY").alias("year_start"),
        F.year(moment).cast("long").alias("year"),
        F.month(moment).cast("long").alias("month"),
        F.weekofyear(moment).cast("long").alias("week"),
        F.dayofmonth(moment).cast("long").alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        weekday_number(day).alias("weekday_number"),
        F.date_sub(day, 1).alias("day_before"),
        F.add_months(day, 48).alias("four_years_on"),
    )


@query("""
    SELECT event_id, date_diff('minute', ts, ended) AS forward, date_diff('minute', ended, ts) AS backward
    FROM (SELECT event_id, ts, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS ended
          FROM events) e""")
def sf_minute_boundaries(t: Tables) -> DataFrame:
    """Minute boundaries crossed between two moments, in both directions."""
    ended = shifted("ts", F.round(F.col("value") * 1000000).cast("bigint"))
    moments = t.events.select("event_id", "ts", ended.alias("ended"))
    return moments.select(
        "event_id",
        minutes_crossed(F.col("ts"), F.col("ended")).alias("forward"),
        minutes_crossed(F.col("ended"), F.col("ts")).alias("backward"),
    )
