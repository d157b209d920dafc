"""Aggregates, distinct sets and ordered summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.functions.times import day_of
from moonstride.operators.filters import all_present
from moonstride.operators.summary import (
    count_per,
    count_where,
    in_spine_order,
    members,
    summary_per_category,
)
from moonstride.sources.literals import literal_table

_MINUTES = {
    "in_bed": "l_extendedprice",
    "asleep": "l_quantity",
    "awake": "l_linenumber",
    "light": "l_discount_minutes",
    "deep": "l_tax_minutes",
    "rem": "l_rem_minutes",
}
_MEANS_SQL = ", ".join(
    f"round(avg({column}), 6) AS {short}_minutes, round(avg({column}) / 60, 6) AS {short}_hours, "
    f"printf('%02d:%02d', CAST(round(avg({column})) AS BIGINT) // 60, CAST(round(avg({column})) AS BIGINT) % 60) "
    f"AS {short}_hhmm"
    for short, column in _MINUTES.items()
)
_SPINE_ROWS = [("Purchase", 1), ("Signup", 2), ("Refund", 3), ("VIEW", 4), ("click", 5)]


@query("SELECT DISTINCT p_brand, p_type, p_size FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL")
def ag_distinct_multi(t: Tables) -> DataFrame:
    return members(t.part.where(all_present("p_brand", "p_type")), "p_brand", "p_type", "p_size")


@query("SELECT DISTINCT CASE WHEN user_id % 10 <> 0 THEN user_id END AS gear FROM events")
def ag_distinct_null_member(t: Tables) -> DataFrame:
    gear = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    return members(t.events.select(gear.alias("gear")), "gear")


@query("""
    SELECT 'every event' AS question, count(*) AS count FROM events
    UNION ALL SELECT 'clicks', count(*) FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'nothing', count(*) FROM events WHERE event_type = 'no such type'""")
def ag_count_where(t: Tables) -> DataFrame:
    """Counts with and without a condition; no row counts 0."""
    kind = F.col("event_type")
    counts = {
        "every event": count_where(t.events),
        "clicks": count_where(t.events, kind == "click"),
        "nothing": count_where(t.events, kind == "no such type"),
    }
    return reduce(DataFrame.union, (c.select(F.lit(q).alias("question"), "count") for q, c in counts.items()))


@query("SELECT CAST(ts AS DATE) AS date_day, count(*) AS activity_count FROM events GROUP BY 1 ORDER BY 1")
def ag_count_per_day(t: Tables) -> DataFrame:
    return count_per(t.events.select(day_of(F.col("ts")).alias("date_day")), "date_day")


@query("SELECT event_type, count(*) AS activity_count FROM events GROUP BY 1 ORDER BY 1")
def ag_count_per_category(t: Tables) -> DataFrame:
    return count_per(t.events, "event_type")


@query(f"""
    SELECT lower(trim(l_returnflag)) AS category, count(*) AS nights, {_MEANS_SQL}
    FROM (SELECT *, l_discount * 1000 AS l_discount_minutes, l_tax * 2000 AS l_tax_minutes,
                 CASE WHEN l_linenumber > 1 THEN l_quantity * 3 END AS l_rem_minutes FROM lineitem) l
    GROUP BY 1""")
def ag_category_summary(t: Tables) -> DataFrame:
    """Number and mean durations per category, as minutes, hours and HH:MM."""
    rows = t.lineitem.select(
        "l_returnflag",
        "l_extendedprice",
        "l_quantity",
        "l_linenumber",
        (F.col("l_discount") * 1000).alias("l_discount_minutes"),
        (F.col("l_tax") * 2000).alias("l_tax_minutes"),
        F.when(F.col("l_linenumber") > 1, F.col("l_quantity") * 3).alias("l_rem_minutes"),
    )
    summary = summary_per_category(rows, "l_returnflag", _MINUTES)
    # sums of doubles depend on their order in the last digits
    rounded = [c for c in summary.columns if c.endswith(("_minutes", "_hours"))]
    return summary.withColumns({c: F.round(c, 6) for c in rounded})


@query("""
    SELECT s.label, s.ordinal, c.rows AS activity_count
    FROM (VALUES ('Purchase', 1), ('Signup', 2), ('Refund', 3), ('VIEW', 4), ('click', 5)) s(label, ordinal)
    JOIN (SELECT event_type, count(*) AS rows FROM events GROUP BY 1) c ON lower(s.label) = c.event_type
    ORDER BY s.ordinal""")
def ag_category_spine(t: Tables) -> DataFrame:
    """Counts in the order of a fixed list of names; a name without rows is left out."""
    spine = literal_table(t.spark, "category string, ordinal int", _SPINE_ROWS)
    counts = t.events.groupBy(F.col("event_type").alias("category")).agg(F.count(F.lit(1)).alias("activity_count"))
    return in_spine_order(counts, spine).select("label", "ordinal", "activity_count")
