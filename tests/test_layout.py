"""Tables laid out by several columns, and days of data kept as bitmaps."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from moonstride.operators import availability
from moonstride.operators.layout import interleave, interleaved_key
from moonstride.operators.lookups import existence_flags
from moonstride.operators.sinks import rebuild_table

START = date(2024, 1, 1)


def files_that_may_hold(stored, column, value):
    """Files whose span of the column admits the value, as a reader of statistics sees them, and all files."""
    spans = stored.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("a"), F.max(column).alias("b")).collect()
    return sum(s["a"] <= value <= s["b"] for s in spans if s["a"] is not None), len(spans)


@pytest.fixture(scope="module")
def facts(spark):
    kind = F.when(F.rand(3) < 0.33, "a").otherwise(F.chr(97 + (F.rand(4) * 20).cast("int")))
    day = F.date_add(F.lit(START), (F.rand(5) * 200).cast("int"))
    return spark.range(20000).select("id", day.alias("day"), kind.alias("kind"))


def test_either_filter_passes_over_most_files(spark, facts, tmp_path):
    both = rebuild_table(facts, "laid_out_both", str(tmp_path / "both"), ranges=64, interleave_by=("day", "kind"))
    alone = rebuild_table(facts, "laid_out_day", str(tmp_path / "day"), ranges=64, cluster_by=("day", "id"))
    try:
        assert both.columns == facts.columns and both.count() == 20000
        for column, value in (("day", START + timedelta(77)), ("kind", "h"), ("kind", "a")):
            held, of = files_that_may_hold(both, column, value)
            assert of >= 48 and held <= 0.5 * of, (column, value, held, of)
        held, of = files_that_may_hold(alone, "kind", "h")
        assert held > 0.9 * of
        assert both.where("kind = 'h' AND day = DATE '2024-03-18'").count() == facts.where("kind = 'h' AND day = DATE '2024-03-18'").count()
    finally:
        spark.sql("DROP TABLE laid_out_both")
        spark.sql("DROP TABLE laid_out_day")


def test_what_is_larger_in_all_columns_comes_later(spark):
    rng = random.Random(1)
    words = ["", "a", "aa", "b", "été", "zz zz", "zz zz zz"]
    rows = [(rng.uniform(-9, 9), rng.choice(words), rng.random() < 0.5) for _ in range(300)]
    df = spark.createDataFrame(rows, "x double, w string, f boolean")
    got = [tuple(r) for r in df.select("*", interleaved_key(df, ("x", "w", "f"), bits=3).alias("k")).collect()]
    for x, w, f, k in got:
        for x2, w2, f2, k2 in got:
            if x <= x2 and w.encode() <= w2.encode() and f <= f2:
                assert k <= k2


@pytest.mark.parametrize("rows", [[], [(None, None, 1)] * 5, [(1, None, 2), (None, "x", 3), (1, "x", 4), (1, "x", 4)]])
def test_nulls_repeats_and_clashing_names(spark, rows):
    df = spark.createDataFrame(rows, "x int, `a.b` string, _place int")
    out = interleave(df, ("x", "a.b"), ranges=3)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_flags_from_bitmaps_equal_flags_from_sources(spark):
    rng = random.Random(2)
    days = [START + timedelta(n) for n in range(-30000, 30000, 500)] + [START + timedelta(n) for n in range(60)] + [date(1970, 1, 1), date(1969, 12, 31), None]
    calendar = spark.createDataFrame([(d, n) for n, d in enumerate(days)], "date_day date, source int")
    loads = {s: [[(rng.choice(days),) for _ in range(80)] for _ in range(3)] for s in ("one", "two")}
    frame = lambda rows: spark.createDataFrame(rows, "date_day date")
    made = [availability.day_bitmaps(frame(rows), s) for s, batches in loads.items() for rows in [*batches, batches[0]]]
    stored = availability.merged(*made)
    flags = {"has_one": "one", "has_two": "two", "has_none": "three"}
    got = availability.availability_flags(calendar, stored, flags)
    assert got.columns == ["date_day", "source", *flags]
    every = {s: frame([r for rows in batches for r in rows]) for s, batches in loads.items()} | {"three": frame([])}
    want = existence_flags(calendar, "date_day", {flag: (every[s], "date_day") for flag, s in flags.items()})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    held = {r["source"]: r["days"] for r in availability.days_held(stored).collect()}
    assert held == {s: len({r for rows in batches for r in rows} - {(None,)}) for s, batches in loads.items()}


def test_bitmaps_of_nothing(spark):
    empty = spark.createDataFrame([], "date_day date")
    stored = availability.merged(availability.day_bitmaps(empty, "one"))
    assert stored.count() == 0
    one = spark.createDataFrame([(START,)], "date_day date")
    assert [tuple(r) for r in availability.availability_flags(one, stored, {"held": "one"}).collect()] == [(START, False)]
    assert availability.availability_flags(empty, stored, {"held": "one"}).count() == 0


def test_flags_do_not_read_the_sources(spark, tmp_path):
    spark.range(50).select(F.date_add(F.lit(START), F.col("id").cast("int")).alias("date_day")).write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    availability.day_bitmaps(source, "one").write.parquet(str(tmp_path / "bits"))
    calendar = spark.range(60).select(F.date_add(F.lit(START), F.col("id").cast("int")).alias("date_day"))
    flags = availability.availability_flags(calendar, spark.read.parquet(str(tmp_path / "bits")), {"held": "one"})
    assert flags.inputFiles() and not any("/source/" in f for f in flags.inputFiles())
    assert flags.where("held").count() == 50
