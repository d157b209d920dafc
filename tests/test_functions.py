"""Expressions on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from moonstride import functions as fn
from moonstride.plans.staging import flatten_activities
from moonstride.session import shuffle_tasks


def values(spark, schema, rows, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_decimal_rounds_the_scaled_double(spark):
    rows = [(1.005,), (2.675,), (0.125,), (-0.125,), (None,), (7.0,)]
    expected = [Decimal(x) if x else None for x in ("1.00", "2.68", "0.13", "-0.13", None, "7.00")]
    assert values(spark, "x double", rows, fn.as_decimal2(F.col("x"))) == expected


def test_integer_rounds_half_to_even(spark):
    rows = [(7.5,), (8.5,), (-7.5,), (7.4,), (None,)]
    assert values(spark, "x double", rows, fn.as_integer(F.col("x"))) == [8, 8, -8, 7, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_minutes_crossed(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [
            ("2024-03-10 10:00:59", "2024-03-10 10:01:01"),
            ("2024-03-10 10:01:01", "2024-03-10 10:00:59"),
            ("2024-03-10 10:00:00", "2024-03-10 10:00:59"),
            # a change to summer time in one zone, which must not matter
            ("2024-03-10 01:30:00", "2024-03-10 03:30:00"),
            ("2024-02-28 23:59:59", "2024-03-01 00:00:00"),
            ("1969-12-31 23:59:59", "1970-01-01 00:00:00"),
            (None, "2024-01-01 00:00:00"),
        ]
        crossed = fn.minutes_crossed(*(F.col(c).cast("timestamp_ntz") for c in "ab"))
        assert values(spark, "a string, b string", rows, crossed) == [1, -1, 0, 120, 1441, 1, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_night_date(spark):
    day, before = date(2024, 1, 10), date(2024, 1, 9)
    rows = [
        (datetime(2024, 1, 10, 0, 30), False),
        (datetime(2024, 1, 10, 0, 30), True),
        (datetime(2024, 1, 10, 0, 30), None),
        (datetime(2024, 1, 10, 11, 59), False),
        (datetime(2024, 1, 10, 12, 0), False),
        (None, False),
    ]
    night = fn.night_date(F.col("t"), F.col("nap"))
    assert values(spark, "t timestamp_ntz, nap boolean", rows, night) == [before, day, day, before, day, None]


def test_minutes_to_hhmm(spark):
    rows = [(479.6,), (0.0,), (59.4,), (6000.0,), (125.0,), (None,)]
    expected = ["08:00", "00:00", "00:59", "100:00", "02:05", None]
    assert values(spark, "m double", rows, fn.minutes_to_hhmm(F.col("m"))) == expected


def test_weeks_and_weekdays(spark):
    rows = [(date(2027, 1, 1),), (date(2024, 12, 30),), (date(2024, 1, 7),), (date(2024, 1, 6),)]
    got = values(spark, "d date", rows, F.weekofyear("d"), fn.weekday_number(F.col("d")))
    assert got == [(53, "5"), (1, "1"), (1, "0"), (1, "6")]


def test_month_number(spark):
    rows = [("March",), ("SEPT",), ("may",), ("Mars",), ("",), (None,)]
    assert values(spark, "m string", rows, fn.month_number(F.col("m"))) == [3, 9, 5, None, None, None]


def test_strip_markup(spark):
    rows = [
        ("```sql\nSELECT 1\n```", "SELECT 1"),
        ("  \"'quoted'\" \n", "quoted"),
        ("plain", "plain"),
        ("a ``` b", "a ``` b"),
        (None, None),
    ]
    got = values(spark, "t string, e string", rows, fn.strip_code_fence(F.col("t")), "e")
    assert all(mine == wanted for mine, wanted in got)
    marked = values(spark, "t string", [("**bold** and `code` *x*",)], fn.strip_inline_markup(F.col("t")))
    assert marked == ["bold and code *x*"]


def test_same_text(spark):
    rows = [(" New Moon", "new moon "), ("New  Moon", "new moon"), (None, "x")]
    assert values(spark, "a string, b string", rows, fn.same_text(F.col("a"), F.col("b"))) == [True, False, None]


def test_flatten_guards_arrays(spark):
    rows = [(1, [], None), (2, None, [1.0, 2.0]), (3, [5.0], [])]
    raw = spark.createDataFrame(rows, "id long, start_latlng array<double>, end_latlng array<double>")
    flat = flatten_activities(raw).orderBy("activity_id")
    assert flat.columns[-1] == "extracted_at"
    coordinates = flat.select("start_latitude", "start_longitude", "end_latitude", "end_longitude").collect()
    expected = [(None, None, None, None), (None, None, 1.0, 2.0), (5.0, None, None, None)]
    assert [tuple(r) for r in coordinates] == expected
    assert flat.select("extracted_at").distinct().count() == 1


def test_shuffles_are_sized_for_the_data():
    assert shuffle_tasks(1) == 200
    assert shuffle_tasks(10 * 2**40) == 81920
    assert shuffle_tasks(100 * 10**12) == 745_059
