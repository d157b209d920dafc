"""Landing files, seeds, tables and loads."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.operators.load import append_new
from moonstride.operators.sinks import as_records, create_view, ensure_schema, rebuild_table, schema_for, write_records, write_snapshot
from moonstride.operators.summary import count_per
from moonstride.session import scratch_path
from moonstride.sources.landing import SECOND_STAMP, read_landing, read_newest, unreadable_files
from moonstride.sources.seeds import moon_calendar_columns, read_activity_mapping, read_moon_calendar
from moonstride.streaming.ingest import ingest_landing, stream_landing

_EVENT_RECORD = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _as_text_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("string"))


def _typed(records: DataFrame) -> DataFrame:
    return records.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _new_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query("SELECT * FROM orders")
def sc_table_scan(t: Tables) -> DataFrame:
    """Scan of a table."""
    return t.orders


@query(_EVENTS)
def sc_json_landing(t: Tables) -> DataFrame:
    """JSON arrays written to landing files, one array per line, and read back."""
    path = scratch_path(t.spark, "landing")
    record = F.struct(*_as_text_time(t.events).columns)
    _as_text_time(t.events).select(F.to_json(F.array(record)).alias("value")).write.text(path)
    return _typed(read_landing(t.spark, path, _EVENT_RECORD))


# Elements of an array, at least and at most; the least holds while there are few files
LEAST_ELEMENTS, MOST_ELEMENTS, FEW_FILES = 500, 20_000, 256


def _elements(events: DataFrame, least: int = LEAST_ELEMENTS) -> tuple[int, int]:
    """How many elements an array gets on average, more of them in larger tables, and the number of arrays."""
    rows = events.count()
    size = min(max(least, rows // FEW_FILES), MOST_ELEMENTS)
    return size, max(1, -(-rows // size))


def _dealt(events: DataFrame, arrays: int) -> Column:
    """The array that a row goes to, whatever its ids look like."""
    return F.pmod(F.xxhash64(*events.columns), F.lit(arrays))


def _arrays(events: DataFrame, indent: str, file: Column) -> DataFrame:
    """The events as JSON arrays over several lines, one per value of ``file``, each the text of a file."""
    record = F.to_json(F.struct(*events.columns), {"pretty": "true"})
    element = F.concat(F.lit(indent), F.regexp_replace(record, "\n", "\n" + indent))
    text = F.concat(F.lit("[\n"), F.array_join(F.collect_list(element), ",\n"), F.lit("\n]"))
    return events.groupBy(file.alias("file")).agg(text.alias("value"))


def _write_files(arrays: DataFrame, path: str) -> None:
    """One file per row, in few folders."""
    folder = F.coalesce(F.pmod("file", F.lit(16)), F.lit(0)).alias("folder")
    files = arrays.select("value", folder)
    files.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("folder").text(path)


@query(_EVENTS)
def sc_indented_landing(t: Tables) -> DataFrame:
    """Arrays indented by two blanks with their brackets, read back in pieces."""
    path = scratch_path(t.spark, "indented")
    events = _as_text_time(t.events)
    _write_files(_arrays(events, "  ", _dealt(events, _elements(events)[1])), path)
    return _typed(read_landing(t.spark, path, _EVENT_RECORD))


@query(_EVENTS)
def sc_json_array(t: Tables) -> DataFrame:
    """Arrays indented in another way; files that are cut off or damaged beside them add nothing."""
    path = scratch_path(t.spark, "arrays")
    events = _as_text_time(t.events)
    file = _dealt(events, _elements(events)[1])
    arrays = _arrays(events, " ", file)
    _write_files(arrays, path)
    _write_files(_arrays(events, "  ", file).withColumn("value", F.expr("substring(value, 1, length(value) - 10)")), path)
    _write_files(arrays.withColumn("value", F.expr("replace(value, '\"value\" :', '\"value\" ')")), path)
    return _typed(read_landing(t.spark, path, _EVENT_RECORD))


@query(_EVENTS)
def sc_split_array(t: Tables) -> DataFrame:
    """Arrays on one line each, larger than what a task is dealt, cut over tasks; a damaged one adds nothing."""
    path = scratch_path(t.spark, "one-line")
    events = _as_text_time(t.events)
    size, number = _elements(events, least=2000)
    groups = events.groupBy(_dealt(events, number).alias("file"))
    arrays = groups.agg(F.to_json(F.collect_list(F.struct(*events.columns))).alias("value"))
    _write_files(arrays, path)
    _write_files(arrays.withColumn("value", F.concat("value", F.lit("}"))), path)
    chunk = t.spark.conf.get("spark.sql.files.maxPartitionBytes")
    t.spark.conf.set("spark.sql.files.maxPartitionBytes", f"{64 * size // 2000}k")  # a few tasks per array
    try:
        return _typed(read_landing(t.spark, path, _EVENT_RECORD))
    finally:
        t.spark.conf.set("spark.sql.files.maxPartitionBytes", chunk)


@query("""
    SELECT CAST(event_id // 500 AS BIGINT) AS file, count(*) AS lost FROM events GROUP BY 1""")
def sc_unreadable_files(t: Tables) -> DataFrame:
    """Of whole and cut files, the cut ones are named; each lacks the records of its array."""
    path = scratch_path(t.spark, "cut")
    events = _as_text_time(t.events)
    _write_files(_arrays(events, "  ", _dealt(events, _elements(events)[1])), path)
    arrays = _arrays(events, "  ", (F.col("event_id") / 500).cast("long"))
    cut = arrays.select("file", F.concat(F.lit("// "), F.col("file").cast("string"), F.lit("\n"), "value").alias("value"))
    _write_files(cut, path)
    bad = unreadable_files(t.spark, path)
    texts = t.spark.read.text(path, wholetext=True)
    named = texts.select("value", F.col("_metadata.file_path").alias("_path")).join(bad, F.col("_path") == F.col("file_path"))
    return named.select(
        F.regexp_extract("value", "^// (\\d+)", 1).cast("long").alias("file"),
        F.regexp_count("value", F.lit('"event_id"')).cast("long").alias("lost"),
    )


@query(_EVENTS)
def sc_newest_snapshot(t: Tables) -> DataFrame:
    """Of three snapshots the newest with a real stamp counts; it holds all events."""
    folder = scratch_path(t.spark, "snapshots")
    events = _as_text_time(t.events)
    write_snapshot(events.where("event_type = 'view'"), folder, "events", datetime(2024, 1, 1))
    write_snapshot(events, folder, "events", datetime(2024, 1, 31, 12))
    write_records(events.where("event_type = 'error'"), f"{folder}/events_20249999_000000.json")
    return _typed(read_newest(t.spark, folder, "events", _EVENT_RECORD, SECOND_STAMP))


@query("""
    SELECT p_brand AS source, 'part ' || p_partkey AS activity_name, p_name AS aligned_activity_name,
           p_size > 25 AS is_sport_exercise FROM part""")
def sc_seed_csv(t: Tables) -> DataFrame:
    """A mapping seed with header and boolean column."""
    path = scratch_path(t.spark, "seed")
    t.part.select(
        F.col("p_brand").alias("source"),
        F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("activity_name"),
        F.col("p_name").alias("aligned_activity_name"),
        (F.col("p_size") > 25).alias("is_sport_exercise"),
    ).write.option("header", True).csv(path)
    return read_activity_mapping(t.spark, path)


@query("""
    SELECT CAST(o_orderdate AS DATE) AS date_day, strftime(o_orderdate, '%A') AS day_of_week,
           strftime(o_orderdate, '%B') AS month, 'phase ' || (count(*) % 8) AS moon_phase,
           CAST(count(*) / CAST(7 AS DOUBLE) AS DECIMAL(10,2)) AS illumination,
           CAST(count(*) % 8 AS INTEGER) AS phase_cycle
    FROM orders GROUP BY o_orderdate""")
def sc_moon_csv(t: Tables) -> DataFrame:
    """A day seed with its original column names, renamed on reading."""
    path = scratch_path(t.spark, "moon")
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("Datum")).agg(F.count(F.lit(1)).alias("n"))
    days.select(
        "Datum",
        F.date_format("Datum", "EEEE").alias("Wochentag"),
        F.date_format("Datum", "MMMM").alias("Monat"),
        F.concat(F.lit("phase "), (F.col("n") % 8).cast("string")).alias("Mondphase"),
        F.round(F.col("n") / 7, 2).cast("decimal(10,2)").alias("Beleuchtung"),
        (F.col("n") % 8).alias("Phasenzyklus"),
    ).write.option("header", True).csv(path)
    return moon_calendar_columns(read_moon_calendar(t.spark, path))


@query("""
    SELECT event_id, event_type, value, CASE WHEN event_type = 'view' THEN 'first' ELSE 'second' END AS load
    FROM events""")
def sk_incremental_append(t: Tables) -> DataFrame:
    """Two loads by id: the second brings all events, the known ones stay as first written."""
    table, path = _new_name("events"), scratch_path(t.spark, "events")
    batch = t.events.select("event_id", "event_type", "value")
    first = batch.where("event_type = 'view'").withColumn("load", F.lit("first"))
    append_new(first, table, "event_id", path)
    # the columns come in another order; the append goes by name
    append_new(batch.select(F.lit("second").alias("load"), "*"), table, "event_id", path)
    return t.spark.table(table)


@query("""
    SELECT event_id, ts, event_type,
           CASE WHEN event_type IN ('view', 'click') THEN 'first' ELSE 'second' END AS load
    FROM events""")
def st_incremental_append(t: Tables) -> DataFrame:
    """Overlapping drops of landing files, one of them broken, loaded by id in several micro-batches."""
    folder = scratch_path(t.spark, "drops")
    events = _as_text_time(t.events).select("event_id", "ts", "event_type")
    first = events.where(F.col("event_type").isin("view", "click"))
    write_records(first.withColumn("load", F.lit("first")), f"{folder}/drop_1")
    write_records(events.withColumn("load", F.lit("second")), f"{folder}/drop_2")
    # files with broken lines add nothing
    broken = F.expr("substring(record, 1, length(record) - 5)").alias("value")
    as_records(events.withColumn("load", F.lit("broken"))).select(broken).write.text(f"{folder}/drop_3")
    table = _new_name("streamed")
    records = stream_landing(t.spark, folder, "event_id bigint, ts string, event_type string, load string", max_files_per_trigger=2)
    job = ingest_landing(
        records, table, "event_id", scratch_path(t.spark, "progress"), scratch_path(t.spark, "streamed")
    )
    job.awaitTermination()
    return _typed(t.spark.table(table))


@query(_EVENTS)
def sk_json_round_trip(t: Tables) -> DataFrame:
    """Records written as JSON lines and read back."""
    path = scratch_path(t.spark, "records")
    write_records(_as_text_time(t.events), path)
    return _typed(read_landing(t.spark, path, _EVENT_RECORD))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def sk_rebuild_table(t: Tables) -> DataFrame:
    """A table built from part of the orders, then replaced by all of them."""
    table, path = _new_name("orders"), scratch_path(t.spark, "orders")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    rebuild_table(orders.where("o_orderstatus = 'F'"), table, path)
    return rebuild_table(orders, table, path)


@query("""
    SELECT 'track' AS schema_name, o_orderkey AS id FROM orders UNION ALL SELECT 'body', c_custkey FROM customer
    UNION ALL SELECT 'seeds', p_partkey FROM part UNION ALL SELECT 'dates', s_suppkey FROM supplier""")
def sk_schema_routing(t: Tables) -> DataFrame:
    """Models built in the schemas that their names and folders call for, and read back from there."""
    models = [
        ("fct_track_orders", "metrics", t.orders.select(F.col("o_orderkey").alias("id"))),
        ("fct_customers", "metrics/body", t.customer.select(F.col("c_custkey").alias("id"))),
        ("parts", "seeds", t.part.select(F.col("p_partkey").alias("id"))),
        ("dim_date_suppliers", "metrics", t.supplier.select(F.col("s_suppkey").alias("id"))),
    ]
    built = []
    for model, folder, rows in models:
        schema, name = schema_for(model, folder), _new_name(model)
        ensure_schema(t.spark, schema)
        rebuild_table(rows, f"{schema}.{name}", scratch_path(t.spark, model))
        owner = t.spark.catalog.getTable(f"{schema}.{name}").namespace[-1]
        built.append(t.spark.table(f"{schema}.{name}").select(F.lit(owner).alias("schema_name"), "id"))
    return reduce(DataFrame.union, built)


@query("""
    SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events
    WHERE event_type = 'click' OR CAST(ts AS DATE) = DATE '2024-01-05'""")
def sk_interleaved_table(t: Tables) -> DataFrame:
    """A table laid out by day and type alike, read by either."""
    rows = t.events.select("event_id", "event_type", F.col("ts").cast("date").alias("day"))
    stored = rebuild_table(rows, _new_name("events"), scratch_path(t.spark, "events"), ranges=16, interleave_by=("day", "event_type"))
    clicks, others = stored.where("event_type = 'click'"), stored.where("day = DATE '2024-01-05' AND NOT event_type <=> 'click'")
    return clicks.union(others)


@query("SELECT o_orderkey, o_totalprice / 2 AS half_price FROM orders")
def sk_view(t: Tables) -> DataFrame:
    """A query under a name."""
    halves = t.orders.select("o_orderkey", (F.col("o_totalprice") / 2).alias("half_price"))
    return create_view(halves, _new_name("halves"))


@query("""
    SELECT '{"event_type":"' || event_type || '","activity_count":' || count(*) || '}' AS record
    FROM events GROUP BY event_type""")
def sk_records(t: Tables) -> DataFrame:
    """A small result as one JSON object per row."""
    return as_records(count_per(t.events, "event_type"))
