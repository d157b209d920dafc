"""Data-quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog import models
from moonstride.catalog.registry import Tables, query
from moonstride.catalog.standins import MOON_SQL, NIGHT_SQL, STAGED_SLEEP_SQL, WORKOUT_SQL
from moonstride.catalog.times import CALENDAR_END
from moonstride.operators import quality
from moonstride.operators.calendar import calendar_from
from moonstride.operators.quality import Check
from moonstride.plans.checks import declared_checks, run_checks

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@query("SELECT event_id, user_id FROM events WHERE CASE WHEN user_id % 10 <> 0 THEN user_id END IS NULL")
def dq_not_null(t: Tables) -> DataFrame:
    gear = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    return quality.not_null(t.events.select("event_id", "user_id", gear.alias("gear")), "gear").drop("gear")


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(t: Tables) -> DataFrame:
    return quality.unique(t.lineitem, "l_orderkey", "l_linenumber")


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""")
def dq_accepted_values(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return quality.accepted_values(orders, "o_orderpriority", _PRIORITIES)


@query("""
    SELECT user_id, count(*) AS child_rows FROM events
    WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)
    GROUP BY user_id""")
def dq_relationships(t: Tables) -> DataFrame:
    """Events whose user is no supplier."""
    return quality.relationships(t.events, "user_id", t.supplier, "s_suppkey")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def dq_min_bound(t: Tables) -> DataFrame:
    return quality.at_least(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 0)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def dq_max_bound(t: Tables) -> DataFrame:
    return quality.at_most(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 45)


@query(f"""
    SELECT end_date, CASE WHEN DATE '2024-01-30' >= end_date THEN 'error' ELSE 'warn' END AS severity
    FROM (SELECT CASE WHEN min(o_orderdate) < DATE '{CALENDAR_END}' THEN DATE '{CALENDAR_END}' END AS end_date
          FROM orders) c
    WHERE DATE '2024-01-30' >= end_date - 3""")
def dq_calendar_horizon(t: Tables) -> DataFrame:
    """The calendar ends in two days, so it warns."""
    calendar = calendar_from(t.orders, "o_orderdate", CALENDAR_END)
    return quality.calendar_horizon(calendar, as_of=date(2024, 1, 30))


@query("""
    WITH e AS (SELECT *, CASE WHEN user_id % 10 <> 0 THEN user_id END AS gear FROM events)
    SELECT 'events' AS table_name, 'gear' AS column_name, 'not_null' AS check_name, 'warn' AS severity,
           (SELECT count(*) FROM e WHERE gear IS NULL) AS violations
    UNION ALL SELECT 'events', 'event_type', 'accepted_values', 'error',
           (SELECT count(*) FROM e WHERE event_type NOT IN ('view', 'click'))
    UNION ALL SELECT 'events', 'value', 'at_least', 'error', (SELECT count(*) FROM e WHERE value < 5)
    UNION ALL SELECT 'events', 'value', 'at_most', 'warn', (SELECT count(*) FROM e WHERE value > 100)
    UNION ALL SELECT 'events', 'event_id', 'unique', 'error',
           (SELECT count(*) FROM (SELECT event_id FROM e GROUP BY 1 HAVING count(*) > 1) u)
    UNION ALL SELECT 'events', 'user_id', 'unique', 'error',
           (SELECT count(*) FROM (SELECT user_id FROM e GROUP BY 1 HAVING count(*) > 1) u)
    UNION ALL SELECT 'events', 'user_id', 'relationships', 'error',
           (SELECT count(*) FROM e WHERE user_id NOT IN (SELECT s_suppkey FROM supplier))
    UNION ALL SELECT 'orders', 'o_orderkey', 'unique', 'error',
           (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) u)
    UNION ALL SELECT 'orders', 'o_totalprice', 'at_least', 'error',
           (SELECT count(*) FROM orders WHERE o_totalprice < 1000)""")
def dq_suite(t: Tables) -> DataFrame:
    """Checks on two tables, one row each with its violations."""
    gear = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    on_events = [
        Check("not_null", "gear").warn_only(),
        Check("accepted_values", "event_type", ("view", "click")),
        Check("at_least", "value", 5),
        Check("at_most", "value", 100).warn_only(),
        Check("unique", "event_id"),
        Check("unique", "user_id"),
        Check("relationships", "user_id", "s_suppkey", parent=t.supplier),
    ]
    on_orders = [Check("unique", "o_orderkey"), Check("at_least", "o_totalprice", 1000)]
    events = quality.run_suite(t.events.withColumn("gear", gear), "events", on_events)
    return events.union(quality.run_suite(t.orders, "orders", on_orders))


# the models that are checked as built, with the SQL that gives their rows
_BUILT_SQL = {
    "stg_body_sleep": f"SELECT * FROM {STAGED_SLEEP_SQL} s",
    "stg_body_workouts": models.STAGED_WORKOUT_SQL,
    "int_body_sleep": f"SELECT * FROM {NIGHT_SQL} n",
    "int_body_workouts": f"SELECT * FROM {WORKOUT_SQL} w",
    "fct_activities": models.SEMANTIC_SQL,
}


def _violations_sql(model: str, check: Check) -> str:
    column, argument = check.column, check.argument
    if check.kind == "unique":
        repeated = f"SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        return f"(SELECT count(*) FROM ({repeated}) r)"
    if check.kind == "relationships":
        parents = f"SELECT CAST({argument} AS DATE) FROM {MOON_SQL} m"
        return f"(SELECT count(*) FROM {model} WHERE {column} IS NOT NULL AND {column} NOT IN ({parents}))"
    accepted = ", ".join(str(v) if isinstance(v, bool) else f"'{v}'" for v in argument) if check.kind == "accepted_values" else ""
    broken = {
        "not_null": f"{column} IS NULL", "at_least": f"{column} < {argument}", "at_most": f"{column} > {argument}",
        "accepted_values": f"{column} NOT IN ({accepted})",
    }[check.kind]
    return f"(SELECT count(*) FROM {model} WHERE {broken})"


def _built_checks_sql() -> str:
    declared = declared_checks()
    rows = [
        f"SELECT '{model}' AS table_name, '{c.column}' AS column_name, '{c.kind}' AS check_name, "
        f"'{c.severity}' AS severity, {_violations_sql(model, c)} AS violations"
        for model in _BUILT_SQL
        for c in declared[model]
    ]
    tables = ", ".join(f"{model} AS MATERIALIZED ({sql})" for model, sql in _BUILT_SQL.items())
    return f"WITH {tables} " + " UNION ALL ".join(rows)


@query(_built_checks_sql())
def dq_built_models(t: Tables) -> DataFrame:
    """All checks declared for the models, over the models as built from the tables."""
    built = models.built_for_checks(t)
    return run_checks({"stg_seeds_moon_data": models.moon_days(t), **built})
