"""Landing files, seeds and insert-only loads, batch and stream."""

import json
import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moonstride.operators.load import append_new, unseen
from moonstride.operators.sinks import as_records, fetch_records, rebuild_table, schema_for, write_records, write_snapshot
from moonstride.plans.loading import KINDS, load_newest
from moonstride.sources import (
    newest_snapshot,
    read_activity_mapping,
    read_landing,
    read_moon_calendar,
    read_newest,
    unreadable_files,
)
from moonstride.sources.landing import DAY_STAMP, SECOND_STAMP, land, landing_files
from moonstride.sources.schemas import SLEEP
from moonstride.sources.seeds import default_activity_mapping, moon_calendar_columns
from moonstride.streaming import ingest_landing, stream_landing
from moonstride.streaming.ingest import keep_first_file, stream_kind

SCHEMA = "id bigint, name string, distance double"


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex}"


def put(folder, name, records):
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write(records if isinstance(records, str) else json.dumps(records, indent=2))
    return path


def contents(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_json_array_over_several_lines(spark, tmp_path):
    put(tmp_path, "a.json", [{"id": 1, "name": "x", "extra": 3}, {"id": 2, "distance": 4.5}])
    df = read_landing(spark, str(tmp_path), SCHEMA)
    assert contents(df, "id", "name", "distance") == [(1, "x", None), (2, None, 4.5)]


def test_array_per_line(spark, tmp_path):
    put(tmp_path, "a.json", '[{"id": 1}, {"id": 2}]\n{"id": 3}\n')
    df = read_landing(spark, str(tmp_path), SCHEMA)
    assert contents(df, "id") == [(1,), (2,), (3,)]


def test_unreadable_file_gives_no_rows_and_its_name(spark, tmp_path):
    put(tmp_path, "bad.json", "no json at all")
    put(tmp_path, "cut.json", '[{"id": 7}, {"id": 8')
    put(tmp_path, "good.json", [{"id": 1, "distance": "far"}, {"id": None}])
    df = read_landing(spark, str(tmp_path), SCHEMA)
    # a field of the wrong type is null; its record stays, as does one without any value
    assert contents(df, "id", "distance") == [(1, None), (None, None)]
    put(tmp_path, "empty.json", "")
    bad = unreadable_files(spark, str(tmp_path)).collect()
    assert sorted(os.path.basename(r["file_path"]) for r in bad) == ["bad.json", "cut.json", "empty.json"]


def test_a_file_cut_anywhere_counts_as_a_whole_or_not_at_all(spark, tmp_path):
    records = [{"id": i, "score": {"a": [i]}, "name": "},\n  },"} for i in range(3)]
    for number, text in enumerate((json.dumps(records, indent=2), json.dumps(records, indent=1), json.dumps(records))):
        folder = tmp_path / str(number)
        folder.mkdir()
        for cut in range(0, len(text), 3):
            put(folder, f"cut_{cut}.json", text[:cut])
        put(folder, "damaged.json", text.replace('"id": 1', '"id" 1'))
        put(folder, "twice.json", text + text)
        put(folder, "whole.json", text)
        put(folder, "crlf.json", text.replace("\n", "\r\n") + "\r\n")
        assert contents(read_landing(spark, str(folder), SCHEMA), "id") == [(0,), (0,), (1,), (1,), (2,), (2,)]
        assert unreadable_files(spark, str(folder)).count() == len(os.listdir(folder)) - 2


def test_json_lines_cut_within_a_line(spark, tmp_path):
    text = "\n".join(json.dumps({"id": i, "score": {"a": i}}) for i in range(4))
    for cut in range(0, len(text), 2):
        put(tmp_path, f"{cut}.json", text[:cut])
    records = land(spark, str(tmp_path), SCHEMA, origin=True).records
    counts = records.groupBy("_landing_file").agg(F.count("id").alias("n")).collect()
    whole = [i for i in range(0, len(text), 2) if text[:i].endswith(("}}", "\n"))]
    assert {os.path.basename(r["_landing_file"]): r["n"] for r in counts} == {f"{i}.json": text[:i].count("}}") for i in whole}


def test_the_writer_is_read_by_the_loader(spark, tmp_path, table):
    folder = str(tmp_path / "landing")
    records = spark.range(20).repartition(3).withColumn("name", F.lit("x"))
    write_snapshot(records, folder, "sleeps", datetime(2024, 1, 2), by_day=True)
    assert load_newest(spark, folder, "sleeps", table, str(tmp_path / "t")) == 20


def test_a_cut_snapshot_is_named_and_does_no_lasting_harm(spark, tmp_path, table, caplog):
    folder = tmp_path / "landing"
    folder.mkdir()
    text = json.dumps([{"id": 5, "user_id": 1, "start": "2024-01-01 00:00:00"}], indent=2)
    put(folder, "cycles_2024-01-05.json", text[: text.index(', \n    "start"') if ', \n' in text else text.index('"start"')])
    assert load_newest(spark, str(folder), "cycles", table, str(tmp_path / "t")) == 0
    assert "cycles_2024-01-05.json" in caplog.text and not spark.catalog.tableExists(table)
    put(folder, "cycles_2024-01-06.json", text)
    assert load_newest(spark, str(folder), "cycles", table, str(tmp_path / "t")) == 1
    assert contents(spark.table(table), "id", "start") == [(5, "2024-01-01 00:00:00")]


def test_snapshots_in_other_folders_do_not_count(spark, tmp_path):
    (tmp_path / "archive").mkdir()
    put(tmp_path / "archive", "activities_20250101_120000.json", [{"id": 2}])
    assert newest_snapshot(spark, str(tmp_path), "activities") is None
    newest = put(tmp_path, "activities_20240101_120000.json", [{"id": 1}])
    assert newest_snapshot(spark, str(tmp_path), "activities").endswith(newest)


def test_kinds_are_streamed_as_they_are_loaded(spark, tmp_path, table):
    folder = tmp_path / "landing"
    folder.mkdir()
    for kind, rules in KINDS.items():
        stamp = "20240101_120000" if kind == "activities" else "2024-01-01"
        put(folder, f"{kind}_{stamp}.json", [{"id": 1, "cycle_id": 1}, {"id": 2, "cycle_id": 2}])
        name, batch = f"{table}_{kind}", f"{table}_{kind}_batch"
        stream = stream_kind(spark, str(folder), kind, max_files_per_trigger=1)
        ingest_landing(stream, name, rules.id_column, str(tmp_path / f"c_{kind}"), str(tmp_path / name)).awaitTermination()
        load_newest(spark, str(folder), kind, batch, str(tmp_path / batch))
        columns = [c for c in spark.table(batch).columns if c != "extracted_at"]
        assert contents(spark.table(name), *columns) == contents(spark.table(batch), *columns)


def test_indented_array_is_read_in_pieces(spark, tmp_path):
    records = [
        {
            "id": i,
            "name": "},\n  }, [" if i % 2 else None,
            "score": {"zones": {"a": i}, "list": [{"x": 1}, {"x": 2}]},
            "distance": i / 4,
            "end": [[1.0], []] if i % 3 else [],
        }
        for i in range(2000)
    ]
    schema = SCHEMA + ", score struct<zones: struct<a: bigint>, list: array<struct<x: bigint>>>, end array<array<double>>"
    path = put(tmp_path, "big.json", records)
    with open(tmp_path / "windows.json", "w", newline="\r\n") as file:
        json.dump([{"id": 9001}, {"id": 9002, "distance": 0.5}], file, indent=2)
    put(tmp_path, "one.json", [{"id": 9003, "distance": "far", "name": "x"}])
    put(tmp_path, "none.json", [])
    put(tmp_path, "flat.json", '[{"id": 9004}, {"id": 9005}]')
    put(tmp_path, "last.json", json.dumps([{"id": 9006}], indent=2) + "\n")
    put(tmp_path, "bad.json", "no json at all")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert [f.form for f in landing_files(spark, path)] == ["indented"]
        pieces = read_landing(spark, path, schema)
        with open(tmp_path / "wide.json", "w") as file:
            json.dump(records, file, indent=4)
        assert contents(pieces, *pieces.columns) == contents(read_landing(spark, f"{tmp_path}/wide.json", schema), *pieces.columns)
        assert pieces.count() == 2000
        everything = read_landing(spark, str(tmp_path), schema)
        small = everything.where("id > 9000")
        assert contents(small, "id", "distance") == [
            (9001, None), (9002, 0.5), (9003, None), (9004, None), (9005, None), (9006, None),
        ]
        bad = unreadable_files(spark, str(tmp_path)).collect()
        assert [os.path.basename(r["file_path"]) for r in bad] == ["bad.json"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_nested_records(spark, tmp_path):
    put(tmp_path, "s.json", [{"id": "s1", "score": {"stage_summary": {"total_in_bed_time_milli": 5}}}, {"id": "s2"}])
    df = read_landing(spark, str(tmp_path), SLEEP)
    assert contents(df, "id", "score.stage_summary.total_in_bed_time_milli") == [("s1", 5), ("s2", None)]


def test_newest_snapshot(spark, tmp_path):
    put(tmp_path, "activities_20240101_120000.json", [{"id": 1}])
    newest = put(tmp_path, "activities_20240301_080000.json", [{"id": 2}])
    put(tmp_path, "activities_20249901_080000.json", [{"id": 3}])
    put(tmp_path, "activities_20250101.json", [{"id": 4}])
    put(tmp_path, "my_activities_20260101_080000.json", [{"id": 5}])
    put(tmp_path, "cycles_2024-05-06.json", [{"id": 6}])
    folder = str(tmp_path)
    assert newest_snapshot(spark, folder, "activities", SECOND_STAMP).endswith(newest)
    assert contents(read_newest(spark, folder, "activities", SCHEMA), "id") == [(2,)]
    assert contents(read_newest(spark, folder, "cycles", SCHEMA, DAY_STAMP), "id") == [(6,)]
    assert read_newest(spark, folder, "sleeps", SCHEMA, DAY_STAMP).count() == 0
    assert newest_snapshot(spark, f"{folder}/missing", "activities") is None
    assert len(os.listdir(tmp_path)) == 6  # nothing is deleted


def test_snapshot_of_several_part_files(spark, tmp_path):
    df = spark.range(100).withColumn("name", F.lit("x")).repartition(4)
    write_records(df, f"{tmp_path}/activities_20240301_080000.json")
    got = read_newest(spark, str(tmp_path), "activities", SCHEMA)
    assert got.count() == 100


def test_mapping_seed_with_crlf(spark, tmp_path):
    text = "source,activity_name,aligned_activity_name,is_sport_exercise\r\nbody,hiit,HIIT,true\r\ntrack,Run,Run,false"
    path = tmp_path / "m.csv"
    path.write_bytes(text.encode())
    df = read_activity_mapping(spark, str(path))
    expected = [("body", "hiit", "HIIT", True), ("track", "Run", "Run", False)]
    assert contents(df, *df.columns) == expected
    built_in = default_activity_mapping(spark)
    assert built_in.count() == 31
    assert built_in.select("activity_name").distinct().count() == 31


def test_moon_seed(spark, tmp_path):
    header = "Datum,Wochentag,Monat,Mondphase,Beleuchtung,Phasenzyklus"
    put(tmp_path, "moon.csv", f"{header}\n2024-01-01,Montag,Januar,Full Moon,99.5,4\n")
    row = moon_calendar_columns(read_moon_calendar(spark, f"{tmp_path}/moon.csv")).first()
    assert (str(row["date_day"]), row["moon_phase"], str(row["illumination"]), row["phase_cycle"]) == (
        "2024-01-01", "Full Moon", "99.50", 4,
    )


def test_known_ids_are_left_alone(spark, tmp_path, table):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b again")], "id int, name string")
    assert append_new(first, table, "id", str(tmp_path / "t")) == 3
    again = spark.createDataFrame([("changed", 1), ("c", 3), ("n1", None), ("n2", None)], "name string, id int")
    assert append_new(again, table, "id") == 3
    assert append_new(again, table, "id") == 0
    expected = [(1, "a"), (2, "b"), (2, "b again"), (3, "c"), (None, "n1"), (None, "n2")]
    assert contents(spark.table(table), "id", "name") == sorted(expected, key=str)


def test_small_batch_does_not_shuffle_the_target(spark, capsys):
    target = spark.read.parquet("/root/testdata/sf0.1/orders.parquet")
    unseen(target.where("o_orderkey < 10"), target, "o_orderkey").explain()
    plan = capsys.readouterr().out
    semi = plan[plan.index("LeftSemi") :]
    known = semi[: semi.index("BroadcastExchange")]
    assert "Exchange" not in known and "BroadcastHashJoin" in plan


def test_stream_appends_only_unseen_ids(spark, tmp_path, table):
    drops = tmp_path / "drops"
    drops.mkdir()

    def run(checkpoint):
        job = ingest_landing(
            stream_landing(spark, str(drops), SCHEMA), table, "id", str(tmp_path / checkpoint), str(tmp_path / "t")
        )
        job.awaitTermination()
        assert job.exception() is None
        return contents(spark.table(table), "id", "name")

    def drop(name, time, rows):
        path = put(drops, name, "\n".join(json.dumps({"id": i, "name": n}) for i, n in rows))
        os.utime(path, (time, time))

    drop("b.json", 1_700_000_000, [(1, "first"), (2, "first"), (None, "n1"), (None, "n2")])
    drop("a.json", 1_700_000_100, [(2, "late"), (3, "late"), (None, "n3")])
    loaded = [(1, "first"), (2, "first"), (3, "late"), (None, "n1"), (None, "n2")]
    assert run("c1") == sorted(loaded, key=str)
    assert run("c1") == sorted(loaded, key=str)
    drop("c.json", 1_700_000_200, [(3, "changed"), (4, "new")])
    loaded.append((4, "new"))
    assert run("c1") == sorted(loaded, key=str)
    # a replay of all files from a new checkpoint adds nothing
    assert run("c2") == sorted(loaded, key=str)


def test_stream_reads_arrays_and_leaves_broken_files_out(spark, tmp_path, table):
    drops = tmp_path / "drops"
    drops.mkdir()
    put(drops, "a.json", [{"id": i, "name": "x"} for i in range(50)])
    put(drops, "b.json", [{"id": 50}])
    put(drops, "cut.json", json.dumps([{"id": i, "name": "cut"} for i in range(60, 70)], indent=2)[:-9])
    put(drops, "bad.json", '{"id": 71}\n{"id": 72')
    records = stream_landing(spark, str(drops), SCHEMA)
    ingest_landing(records, table, "id", str(tmp_path / "c"), str(tmp_path / "t")).awaitTermination()
    assert contents(spark.table(table).where("name is null or id = 49"), "id") == [(49,), (50,)]
    assert spark.table(table).count() == 51


def test_first_file_wins_whatever_its_size(spark):
    rows = [(1, f"f{n % 3}", n % 3) for n in range(300)] + [(None, "f2", 2), (None, "f1", 1), (None, "f1", 1)]
    batch = spark.createDataFrame(rows, "id int, _landing_file string, n int").withColumn(
        "_landing_time", F.timestamp_seconds(F.lit(1_700_000_000))
    )
    kept = keep_first_file(batch, "id").groupBy("id", "n").count().collect()
    assert sorted((tuple(r) for r in kept), key=str) == [(1, 0, 100), (None, 1, 2)]


def test_kinds_are_loaded_from_their_newest_snapshot(spark, tmp_path, table):
    folder = tmp_path / "landing"
    folder.mkdir()

    def load(kind):
        name = f"{table}_{kind}"
        added = load_newest(spark, str(folder), kind, name, str(tmp_path / name))
        return added, contents(spark.table(name), KINDS[kind].id_column) if spark.catalog.tableExists(name) else None

    assert load("cycles") == (0, None)
    put(folder, "activities_20240101_120000.json", [{"id": 1, "name": "a", "start_latlng": [1.0, 2.0]}, {"id": 2}])
    assert load("activities") == (2, [(1,), (2,)])
    put(folder, "activities_20240102_120000.json", [{"id": 2, "name": "changed"}, {"id": 3}])
    assert load("activities") == (1, [(1,), (2,), (3,)])
    assert load("activities") == (0, [(1,), (2,), (3,)])
    assert contents(spark.table(f"{table}_activities").where("activity_id = 2"), "name") == [(None,)]
    for kind in ("cycles", "recoveries", "sleeps", "workouts"):
        put(folder, f"{kind}_2024-01-02.json", [{KINDS[kind].id_column: 5}])
        assert load(kind)[0] == 1
        assert load(kind)[0] == 0


def test_snapshots_are_named_for_the_reader(spark, tmp_path):
    records = spark.createDataFrame([(1,)], "id bigint")
    folder = str(tmp_path)
    for day in (1, 3, 2):
        write_snapshot(records, folder, "sleeps", datetime(2024, 1, day), by_day=True)
    assert newest_snapshot(spark, folder, "sleeps", DAY_STAMP).endswith("sleeps_2024-01-03.json")
    assert fetch_records(records, 5) == [{"id": 1}]


def test_schema_routing():
    assert schema_for("x", explicit=" seeds ") == "seeds"
    assert schema_for("fct_body_sleeps", "track") == "body"
    assert schema_for("any", "metrics/track") == "track"
    assert schema_for("moon", "seeds") == "seeds"
    assert schema_for("dim_dates") == "dates"
    assert schema_for("fct_activities", "semantic") == "semantic"
    assert schema_for("other") == "main"
    assert schema_for("fct_watch_x", sources=("watch", "bike")) == "watch"


def test_records_keep_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert [r["record"] for r in as_records(df).collect()] == ['{"a":1,"b":null}']


def test_a_clustered_table_is_read_by_days(spark, tmp_path, table):
    days = spark.range(3000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("date_day"))
    stored = rebuild_table(days.repartition(8), table, str(tmp_path / "t"), cluster_by=("date_day", "id"), ranges=6)
    per_file = stored.groupBy(F.col("_metadata.file_path")).agg(F.min("date_day").alias("a"), F.max("date_day").alias("b"))
    spans = sorted((r["a"], r["b"]) for r in per_file.collect())
    assert len(spans) == 6 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert stored.count() == 3000
