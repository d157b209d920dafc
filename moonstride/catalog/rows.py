"""Projections and expressions over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.catalog.standins import FLAT_ACTIVITY_SQL, activity_records
from moonstride.functions import measures
from moonstride.functions.text import month_number, strip_code_fence, strip_inline_markup
from moonstride.functions.times import night_date
from moonstride.operators.lookups import rejoin
from moonstride.plans.staging import flatten_activities


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
           CAST(o_totalprice AS INTEGER) AS whole_price, CAST(o_orderdate AS DATE) AS order_day,
           o_orderstatus = 'F' AS is_filled
    FROM orders""")
def pr_typed_projection(t: Tables) -> DataFrame:
    """Casts with new names; doubles become whole numbers by rounding half to even."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        measures.as_integer(F.col("o_totalprice")).alias("whole_price"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        (F.col("o_orderstatus") == "F").alias("is_filled"),
    )


@query("SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority FROM orders")
def pr_vertical_split(t: Tables) -> DataFrame:
    """Two facts of one grain, joined again on their id."""
    prices = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    labels = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return rejoin(prices, labels, "o_orderkey")


@query("""
    SELECT event_id, k AS direct, CASE WHEN event_id % 13 <> 0 THEN k END AS nested
    FROM (SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events) e""")
def pr_struct_fields(t: Tables) -> DataFrame:
    """Fields two and three levels deep; a missing parent gives null."""
    parsed = F.from_json("props", "k bigint")
    inner = F.struct(F.struct(parsed["k"].alias("k")).alias("stage_summary"))
    records = t.events.select(
        "event_id", parsed.alias("props"), F.when(F.col("event_id") % 13 != 0, inner).alias("score")
    )
    return records.select(
        "event_id", F.col("props.k").alias("direct"), F.col("score.stage_summary.k").alias("nested")
    )


@query("""
    SELECT vec_id, CAST(first AS DOUBLE) AS first, CAST(second AS DOUBLE) AS second,
           CAST(NULL AS DOUBLE) AS beyond
    FROM (SELECT vec_id, CASE WHEN label % 3 = 0 THEN NULL ELSE embedding[1] END AS first,
                 CASE WHEN label % 3 = 0 THEN NULL ELSE embedding[2] END AS second FROM embeddings) e""")
def pr_array_element(t: Tables) -> DataFrame:
    """Array elements; an empty or short array gives null."""
    vector = F.when(F.col("label") % 3 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding"))
    vectors = t.embeddings.select("vec_id", vector.alias("v"))
    return vectors.select(
        "vec_id",
        F.get("v", 0).cast("double").alias("first"),
        F.get("v", 1).cast("double").alias("second"),
        F.get("v", 100000).cast("double").alias("beyond"),
    )


@query(f"SELECT * FROM {FLAT_ACTIVITY_SQL} f")
def pr_flatten_record(t: Tables) -> DataFrame:
    """Nested records to wide rows (the load time is left out here: it has no fixed value)."""
    return flatten_activities(activity_records(t.events)).drop("extracted_at")


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice + l_discount + l_tax AS total,
           l_extendedprice + l_quantity + l_discount - l_tax AS need
    FROM lineitem""")
def pr_measure_sum(t: Tables) -> DataFrame:
    """Sums and differences of measures; a null makes the result null."""
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (price + discount + tax).alias("total"),
        (price + F.col("l_quantity") + discount - tax).alias("need"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice / 60000 AS minutes_from_millis,
           l_linenumber / 60 AS minutes_from_seconds, l_quantity / 3600 AS hours_from_seconds,
           l_quantity / 60 AS hours_from_minutes, l_extendedprice / 1000 AS kilometers,
           l_quantity * CAST(3.6 AS DOUBLE) AS kilometers_per_hour
    FROM lineitem""")
def pr_unit_conversion(t: Tables) -> DataFrame:
    """All unit conversions; results are unrounded doubles."""
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        measures.minutes_from_millis(price).alias("minutes_from_millis"),
        measures.minutes_from_seconds(F.col("l_linenumber")).alias("minutes_from_seconds"),
        measures.hours_from_seconds(quantity).alias("hours_from_seconds"),
        measures.hours_from_minutes(quantity).alias("hours_from_minutes"),
        measures.kilometers(price).alias("kilometers"),
        measures.kilometers_per_hour(quantity).alias("kilometers_per_hour"),
    )


@query("""
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS price,
           CAST(o_totalprice / 8 AS DECIMAL(10,2)) AS eighth, CAST(o_totalprice / 7 AS DECIMAL(10,2)) AS seventh
    FROM orders""")
def pr_decimal_measures(t: Tables) -> DataFrame:
    """Doubles to decimal(10,2), ties included."""
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        measures.as_decimal2(price).alias("price"),
        measures.as_decimal2(price / 8).alias("eighth"),
        measures.as_decimal2(price / 7).alias("seventh"),
    )


@query("""
    SELECT event_id, CASE WHEN extract(hour FROM ts) < 12 AND nap IS FALSE
                          THEN CAST(CAST(ts AS DATE) - INTERVAL '1 day' AS DATE)
                          ELSE CAST(ts AS DATE) END AS date_day
    FROM (SELECT event_id, ts, CASE WHEN event_id % 11 <> 0 THEN event_id % 7 = 0 END AS nap FROM events) e""")
def pr_night_attribution(t: Tables) -> DataFrame:
    """The night a sleep belongs to; unknown naps keep their day."""
    nap = F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 7 == 0)
    return t.events.select("event_id", night_date(F.col("ts"), nap).alias("date_day"))


@query("""
    SELECT doc_id,
           trim(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
               '```sql' || chr(10) || '"' || text || '"' || chr(10) || '```',
               '(?m)^```sql\\s*', '', 'g'), '(?m)^```\\s*', '', 'g'), '^\\s+', ''), '\\s+$', ''), '"'), '''') AS bare,
           regexp_replace(regexp_replace('**' || lang || '** ' || text || ' `' || source || '`',
               '\\*\\*([^*]+)\\*\\*', '\\1', 'g'), '`([^`]+)`', '\\1', 'g') AS plain
    FROM documents""")
def sf_strip_markup(t: Tables) -> DataFrame:
    """Whole documents in fences and quotes, and with bold and code marks, stripped again."""
    fenced = F.concat(F.lit('```sql\n"'), F.col("text"), F.lit('"\n```'))
    marked = F.concat(
        F.lit("**"), F.col("lang"), F.lit("** "), F.col("text"), F.lit(" `"), F.col("source"), F.lit("`")
    )
    return t.documents.select(
        "doc_id", strip_code_fence(fenced).alias("bare"), strip_inline_markup(marked).alias("plain")
    )


@query("""
    SELECT l_orderkey, l_linenumber, printf('%02d:%02d', total // 60, total % 60) AS hhmm
    FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice / 100 + 0.5) AS BIGINT) AS total
          FROM lineitem) m""")
def sf_minutes_to_hhmm(t: Tables) -> DataFrame:
    """Minutes as HH:MM."""
    minutes = F.col("l_extendedprice") / 100
    return t.lineitem.select("l_orderkey", "l_linenumber", measures.minutes_to_hhmm(minutes).alias("hhmm"))


@query("""
    SELECT o_orderkey, CAST(extract(month FROM o_orderdate) AS INTEGER) AS from_name,
           CAST(extract(month FROM o_orderdate) AS INTEGER) AS from_short,
           CAST(NULL AS INTEGER) AS from_other
    FROM orders""")
def sf_month_number(t: Tables) -> DataFrame:
    """Month names and abbreviations in any case to numbers."""
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        month_number(F.upper(F.date_format(day, "MMMM"))).alias("from_name"),
        month_number(F.date_format(day, "MMM")).alias("from_short"),
        month_number(F.col("o_orderpriority")).alias("from_other"),
    )
