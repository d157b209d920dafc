"""Checks and joins on small rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from moonstride.operators import quality
from moonstride.operators.calendar import calendar_from
from moonstride.operators.lookups import existence_flags, foreign_key, left_lookup, rejoin, without_match
from moonstride.operators.quality import Check
from moonstride.operators.summary import count_where, in_spine_order, latest, summary_per_category


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "a", 5.0), (2, "b", -1.0), (2, "c", None), (None, None, 200.0), (None, "a", 1.0)]
    return spark.createDataFrame(rows, "id int, kind string, v double")


def test_checks_return_the_violating_rows(spark, df):
    assert quality.not_null(df, "id").count() == 2
    assert [tuple(r) for r in quality.unique(df, "id").collect()] == [(2, 2)]
    assert quality.unique(df, "id", "kind").count() == 0
    assert [r["kind"] for r in quality.accepted_values(df, "kind", ("a", "b")).collect()] == ["c"]
    assert [r["v"] for r in quality.at_least(df, "v", 0).collect()] == [-1.0]
    assert [r["v"] for r in quality.at_most(df, "v", 100).collect()] == [200.0]
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert sorted(tuple(r) for r in quality.relationships(df, "kind", parent, "name").collect()) == [("b", 1), ("c", 1)]


def test_suite_counts_violations(spark, df):
    parent = spark.createDataFrame([("a",)], "name string")
    checks = [
        Check("not_null", "id"),
        Check("unique", "id"),
        Check("unique", "id, kind"),
        Check("accepted_values", "kind", ("a", "b")).warn_only(),
        Check("at_least", "v", 0),
        Check("at_most", "v", 1000),
        Check("relationships", "kind", "name", parent=parent),
    ]
    got = {(r["column_name"], r["check_name"]): r for r in quality.run_suite(df, "t", checks).collect()}
    counts = {key: r["violations"] for key, r in got.items()}
    assert counts == {
        ("id", "not_null"): 2,
        ("id", "unique"): 1,
        ("id, kind", "unique"): 0,
        ("kind", "accepted_values"): 1,
        ("v", "at_least"): 1,
        ("v", "at_most"): 0,
        ("kind", "relationships"): 2,
    }
    assert got["kind", "accepted_values"]["severity"] == "warn"
    empty = quality.run_suite(df.where("false"), "t", checks).collect()
    assert len(empty) == len(checks) and all(r["violations"] == 0 for r in empty)


def test_row_checks_share_one_scan(spark, capsys):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    checks = [Check("not_null", c) for c in orders.columns] + [Check("at_least", "o_totalprice", 0)]
    quality.run_suite(orders, "orders", checks).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


@pytest.mark.parametrize(
    "today, severity",
    [(date(2024, 1, 28), None), (date(2024, 1, 29), "warn"), (date(2024, 1, 31), "warn"), (date(2024, 2, 1), "error")],
)
def test_calendar_horizon(spark, today, severity):
    calendar = calendar_from(spark.createDataFrame([(date(2024, 1, 5),)], "date_day date"), end=date(2024, 2, 1))
    rows = quality.calendar_horizon(calendar, today).collect()
    assert [r["severity"] for r in rows] == ([severity] if severity else [])


def test_an_empty_calendar_is_an_error(spark):
    rows = quality.calendar_horizon(spark.createDataFrame([], "date_day date"), date(2024, 1, 1)).collect()
    assert [(r["end_date"], r["severity"]) for r in rows] == [(None, "error")]


def test_calendar_counts_spine_days(spark):
    days = calendar_from(spark.createDataFrame([(date(2023, 12, 30),)], "d date"), "d", date(2024, 1, 3)).orderBy("date_day")
    got = [(str(r["date_day"]), r["day_of_year"], r["week"], r["is_weekend"]) for r in days.collect()]
    assert got == [
        ("2023-12-30", 1, 52, True),
        ("2023-12-31", 2, 52, True),
        ("2024-01-01", 1, 1, False),
        ("2024-01-02", 2, 1, False),
    ]
    assert calendar_from(spark.createDataFrame([], "d date"), "d").count() == 0


def test_null_keys(spark):
    fact = spark.createDataFrame([(1, "g1"), (2, None), (3, "g9")], "id int, gear string")
    dim = spark.createDataFrame([("g1", 10), (None, 11)], "gear string, gear_id int")
    plain = foreign_key(fact, dim, ("gear",), "gear_id").collect()
    safe = foreign_key(fact, dim, ("gear",), "gear_id", null_safe=True).collect()
    assert {r["id"]: r["gear_id"] for r in plain} == {1: 10, 2: None, 3: None}
    assert {r["id"]: r["gear_id"] for r in safe} == {1: 10, 2: 11, 3: None}


def test_lookup_is_case_sensitive_and_keeps_rows(spark):
    fact = spark.createDataFrame([(1, "Run"), (2, "run"), (3, None)], "id int, kind string")
    lookup = spark.createDataFrame([("Run", "x")], "kind string, name string")
    got = left_lookup(fact, lookup, "kind", "kind")
    assert {r["id"]: r["name"] for r in got.collect()} == {1: "x", 2: None, 3: None}


def test_flags_do_not_multiply_rows(spark):
    days = spark.createDataFrame([(1,), (2,), (None,)], "d int")
    hot = spark.createDataFrame([(1,)] * 100 + [(None,)] * 5, "x int")
    got = existence_flags(days, "d", {"hot": (hot, "x"), "none": (hot.where("false"), "x")}).collect()
    assert sorted((tuple(r) for r in got), key=str) == [(1, True, False), (2, False, False), (None, False, False)]
    assert without_match(days, hot, "d", "x").count() == 2


def test_rejoin(spark):
    left = spark.createDataFrame([(1, "a", 5)], "id int, x string, day int")
    right = spark.createDataFrame([(1, "b", 5)], "id int, y string, day int")
    assert rejoin(left, right, "id").columns == ["id", "x", "day", "y"]


def test_summary_skips_nulls_and_folds_case(spark):
    rows = [(" Full Moon", 60.0), ("full moon", 90.5), ("FULL MOON ", None), (None, 1.0), ("New Moon", 479.6)]
    df = spark.createDataFrame(rows, "phase string, m double")
    spine = spark.createDataFrame([("New Moon", 1), ("Gone", 2), ("Full Moon", 3)], "category string, ordinal int")
    got = [tuple(r) for r in in_spine_order(summary_per_category(df, "phase", {"x": "m"}), spine).collect()]
    assert got == [(1, 479.6, 479.6 / 60, "08:00", "New Moon", 1), (3, 75.25, 75.25 / 60, "01:15", "Full Moon", 3)]


def test_latest_and_count(spark):
    rows = [(i, date(2024, 1, 1 + i % 3) if i else None) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, d date")
    assert [r["id"] for r in latest(df, "d", "id", 3).collect()] == [8, 5, 2]
    assert latest(df, "d", "id", 50).collect()[-1]["id"] == 0
    assert count_where(df, F.lit(False)).first()["count"] == 0
