"""Counts kept per day and category, and questions answered from them."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from moonstride.functions.text import strip_code_fence
from moonstride.operators.counts import day_counts, refreshed_counts
from moonstride.operators.questions import answer, answer_from_counts, count_answers, count_answers_from, read_question
from moonstride.session import stage

SCHEMA = "id long, date_day date, activity_name string, is_sport_exercise boolean, n int"
AS_OF = date(2024, 6, 15)
TEXTS = [
    "How many runs in March 2024?", "How many rides?", "how many sport sessions in May", "Count my walks per day in April 2024",
    "How many per day", "count runs this month", "How many activities in the last 30 days",
]


def made(rng, n, first=0):
    """Rows of which a third fall on one day; some have no day, name or flag."""
    names = [("Run", True), ("Cycling", True), ("Walking", False), (None, None), ("Commuting", None)]
    day = lambda: AS_OF if rng.random() < 0.33 else None if rng.random() < 0.1 else date(2024, 2, 1) + timedelta(rng.randrange(140))
    return [(first + i, day(), *rng.choice(names), 7) for i in range(n)]


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_late_rows_and_lost_rows(spark, seed):
    rng = random.Random(seed)
    early, late = made(rng, 300), made(rng, 40, 300)
    gone = [r for r in early if r[0] % 50 == 0]
    before = spark.createDataFrame(early, SCHEMA)
    after = spark.createDataFrame([r for r in early if r not in gone] + late, SCHEMA)
    changed = spark.createDataFrame([(r[1],) for r in late + gone], "date_day date")
    counts = stage(refreshed_counts(stage(day_counts(before), "counts"), after, changed), "counts")
    assert rows_of(counts) == rows_of(day_counts(after))
    assert rows_of(refreshed_counts(counts, after, changed)) == rows_of(counts)
    for text in TEXTS:
        reading = read_question(spark, text, AS_OF)
        assert rows_of(answer_from_counts(counts, reading)) == rows_of(answer(after, reading, "id")), text
    asked = spark.createDataFrame([(t,) for t in TEXTS], "question string")
    assert rows_of(count_answers_from(asked, counts, as_of=F.lit(AS_OF))) == rows_of(count_answers(asked, after, as_of=F.lit(AS_OF)))


def test_nothing_changed_and_nothing_there(spark):
    empty = spark.createDataFrame([], SCHEMA)
    no_days = spark.createDataFrame([], "date_day date")
    some = day_counts(spark.createDataFrame([(1, None, None, None, 1)], SCHEMA))
    assert rows_of(refreshed_counts(some, empty, no_days)) == rows_of(some)
    undated = spark.createDataFrame([(None,)], "date_day date")
    assert refreshed_counts(some, empty, undated).count() == 0
    assert [tuple(r) for r in answer_from_counts(day_counts(empty), read_question(spark, "How many runs?")).collect()] == [(0,)]
    with pytest.raises(ValueError):
        answer_from_counts(some, read_question(spark, "List my runs"))


def test_only_the_span_of_changed_days_is_read(spark, tmp_path):
    spark.createDataFrame(made(random.Random(4), 50), SCHEMA).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    counts = stage(day_counts(fact), "counts")
    fresh = refreshed_counts(counts, fact, spark.createDataFrame([(date(2024, 3, 1),), (date(2024, 3, 4),)], "date_day date"))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_day,2024-03-01)" in plan and "LessThanOrEqual(date_day,2024-03-04)" in plan


def test_fences_are_stripped_as_python_strips(spark):
    texts = ["```sql\nSELECT 1\n```", "  'a'  ", "\"'b'\"", "''\"c\"''", "\t\n", "", "abc'\n\"", "\"\"x y\"'", None, "`q`"]
    bare = lambda t: t and t.replace("```sql\n", "").replace("```", "").strip(" \t\n\x0b\f\r").strip('"').strip("'")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_code_fence(F.col("t"))).collect()] == [bare(t) for t in texts]
