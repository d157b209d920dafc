"""Running numbers against a plain sort, with the keys that hurt."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moonstride.operators import sequence
from moonstride.operators.sequence import nth_of_day, number_by_time, number_rows, surrogate_keys

START = datetime(2024, 1, 1)


def brute_force(rows):
    """id -> (number, number of day), for rows (id, moment, payload)."""
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[0]))
    seen, result = defaultdict(int), {}
    for number, (key, moment, _) in enumerate(ordered, start=1):
        day = moment and moment.date()
        seen[day] += 1
        result[key] = (number, seen[day])
    return result


def hot_rows(kind, count=3000):
    rng = random.Random(7)
    rows = []
    for i in range(count):
        moment = START + timedelta(minutes=rng.randrange(60 * 24 * 20))
        if kind == "hot moment" and i % 2:
            moment = START + timedelta(days=3)
        if kind == "hot day" and i % 2:
            moment = START + timedelta(days=3, seconds=i)
        if kind == "no moment" and i % 2:
            moment = None
        if kind == "one moment":
            moment = START
        rows.append((i, moment, f"row {i}"))
    rng.shuffle(rows)
    return rows


@pytest.fixture(params=["even", "hot moment", "hot day", "no moment", "one moment"])
def rows(request):
    return hot_rows(request.param)


@pytest.mark.parametrize("payload", [True, False])
def test_number_by_time(spark, rows, payload):
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, payload string").repartition(7)
    df = df if payload else df.drop("payload")
    got = number_by_time(df, "ts", "id", "n", "n_of_day").collect()
    assert {r["id"]: (r["n"], r["n_of_day"]) for r in got} == brute_force(rows)
    assert len(got) == len(rows)
    if payload:
        assert all(r["payload"] == f"row {r['id']}" for r in got)


def test_several_range_parts(spark, rows):
    """The numbers do not depend on where the ranges are cut."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, payload string")
        placed = sequence._range_sorted(df.drop("payload"), ("ts", "id"))
        sizes = [r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) > 4 and max(sizes) < len(rows) / 2  # hot moments are split by id
        got = number_by_time(df, "ts", "id", "n", "d").collect()
        assert {r["id"]: (r["n"], r["d"]) for r in got} == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_repeated_ids_keep_every_row(spark):
    rows = [(i % 10, START + timedelta(days=i % 4), f"row {i}") for i in range(400)]
    rows += [(None, None, f"bare {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, payload string")
    got = number_by_time(df, "ts", "id", "n", "d").collect()
    assert sorted(r["n"] for r in got) == list(range(1, 451))
    assert sorted(r["payload"] for r in got) == sorted(r[2] for r in rows)
    by_day = defaultdict(list)
    for r in got:
        by_day[r["ts"]].append(r["d"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_day.values())


def test_copies_of_one_key_are_spread(spark, monkeypatch):
    """Half of the rows have neither time nor id, and no task gets them all."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    parts = []
    sort = sequence._range_sorted

    def watched(df, order):
        placed = sort(df, order)
        parts.append([r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()])
        return placed

    monkeypatch.setattr(sequence, "_range_sorted", watched)
    try:
        rows = [(i, START + timedelta(hours=i)) if i % 2 else (None, None) for i in range(4000)]
        df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
        got = number_by_time(df, "ts", "id", "n", "d").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sorted(r["n"] for r in got) == list(range(1, 4001))
    assert sorted(r["d"] for r in got if r["ts"] is None) == list(range(1, 2001))
    assert sum(parts[-1]) == 4000 and max(parts[-1]) < 1000


def test_one_null_id_is_numbered(spark):
    rows = [(1, START, "a"), (None, START, "b"), (2, None, "c")]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, payload string")
    got = {r["payload"]: (r["n"], r["d"]) for r in number_by_time(df, "ts", "id", "n", "d").collect()}
    assert got == {"a": (1, 1), "b": (2, 2), "c": (3, 1)}


def test_empty(spark):
    df = spark.createDataFrame([], "id long, ts timestamp_ntz, payload string")
    assert number_by_time(df, "ts", "id", "n", "d").count() == 0
    assert number_rows(df, ("ts", "id"), "n").count() == 0


def test_nth_of_day(spark, rows):
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, payload string")
    numbers = brute_force(rows)
    for n in (1, 2):
        got = {r["id"] for r in nth_of_day(df, "ts", "id", n).collect()}
        assert got == {key for key, (_, of_day) in numbers.items() if of_day == n}


def test_groups_are_limited_before_the_shuffle(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    nth_of_day(df, "ts", "event_id").explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_surrogate_keys_put_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("B",)], "name string")
    got = surrogate_keys(df, ("name",), "key").orderBy("key").collect()
    assert [tuple(r) for r in got] == [(1, "B"), (2, "a"), (3, "b"), (4, None)]
