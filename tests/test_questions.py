"""Reading and answering questions."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from moonstride.operators import questions as q

AS_OF = date(2025, 7, 15)


def scopes(spark, texts, strict=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, question string")
    read = q.with_date_scope(df, "question", F.lit(AS_OF), strict).orderBy("i")
    return [r["scope"] and tuple(r["scope"]) for r in read.collect()]


def test_date_scopes(spark):
    cases = {
        "How many runs in March 2025?": ("month_of_year", date(2025, 3, 1), date(2025, 4, 1), None, None),
        "in December 2024": ("month_of_year", date(2024, 12, 1), date(2025, 1, 1), None, None),
        "runs in March": ("month", None, None, 3, None),
        "runs in sept and later": ("month", None, None, 9, None),
        "in March?": ("month", None, None, 3, None),
        "within March": ("month", None, None, 3, None),
        "runs in 2025": ("year", date(2025, 1, 1), date(2026, 1, 1), None, None),
        "during 2023": ("year", date(2023, 1, 1), date(2024, 1, 1), None, None),
        "the last 30 days": ("last_days", date(2025, 6, 15), None, None, 30),
        "past 1 day": ("last_days", date(2025, 7, 14), None, None, 1),
        "This Month": ("this_month", date(2025, 7, 1), date(2025, 8, 1), None, None),
        "this year": ("this_year", date(2025, 1, 1), date(2026, 1, 1), None, None),
        "in brunch 2024": None,
        "in total": None,
        "last 99999999999 days": ("last_days", date(1, 1, 1), None, None, 2**31 - 1),
        "last 2147483647 days": ("last_days", date(1, 1, 1), None, None, 2**31 - 1),
        "": None,
    }
    assert scopes(spark, list(cases)) == list(cases.values())


def test_strict_wants_a_blank_after_the_month(spark):
    assert scopes(spark, ["in March?", "in March"], strict=True) == [None, ("month", None, None, 3, None)]


def categories(spark, texts, strict=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    read = df.select("i", q.category(F.col("t"), strict).alias("c")).orderBy("i")
    return [r["c"] and tuple(r["c"]) for r in read.collect()]


def test_categories(spark):
    cases = {
        "My running": ("Run", None),
        "RUNS and rides": ("Run", None),
        "bike tours": ("Cycling", None),
        "swimming": ("Swim", None),
        "hikes": ("Hiking", None),
        "yoga": ("Yoga", None),
        "strength sessions": ("WeightTraining", None),
        "any exercise": (None, True),
        "brunch": None,
        "activities": None,
    }
    assert categories(spark, list(cases)) == list(cases.values())
    strict = categories(spark, ["brunch", "bike", "hiking", "walk"], strict=True)
    assert strict == [("Run", None), ("Ride", None), ("Hike", None), ("Walk", None)]


def test_intents(spark):
    cases = {
        "How many runs": "count",
        "count them each day": "count_per_day",
        "Which runs": "list",
        "show me": "list",
        "my runs": "default",
        "What is the count": "count",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    assert [r["x"] for r in df.orderBy("i").select(q.intent(F.col("t")).alias("x")).collect()] == list(cases.values())


@pytest.fixture(scope="module")
def fact(spark):
    rows = []
    for i in range(1200):
        name, flag = [("Run", True), ("Cycling", True), ("Commuting", False), (None, None)][i % 4]
        day = None if i % 50 == 0 else date(2024, 11, 1) + timedelta(days=i // 4)
        rows.append((i, day, name, flag))
    schema = "activity_id long, date_day date, activity_name string, is_sport_exercise boolean"
    return spark.createDataFrame(rows, schema)


def test_one_question_at_a_time_gives_what_the_batch_gives(spark, fact):
    texts = [
        "How many runs in March 2025?",
        "How many runs in December 2024",
        "how many activities in April",
        "How many bike rides in 2024",
        "how many sport sessions this month",
        "count the walks this year",
        "how many in the last 20 days",
        "How many yoga classes in May 2025?",
        "how many in 1990?",
        "how many runs in 2090",
        "How many activities did I do?",
        "List runs in 2025",
        "how many runs per day",
    ]
    asked = spark.createDataFrame([(t,) for t in texts], "question string")
    batch = {r["question"]: r["answer"] for r in q.count_answers(asked, fact, as_of=F.lit(AS_OF)).collect()}
    assert set(batch) == set(texts[:-2])
    for text, answer in batch.items():
        single = q.answer(fact, q.read_question(spark, text, AS_OF), "activity_id")
        assert single.first()["count"] == answer, text
    assert batch["how many in 1990?"] == 0 and batch["How many activities did I do?"] == 1200


def test_answers(spark, fact):
    def ask(text):
        return q.answer(fact, q.read_question(spark, text, AS_OF), "activity_id")

    assert ask("list all").count() == 50
    assert ask("my runs").count() == 10
    newest = ask("show runs in 2025").first()
    assert newest["activity_name"] == "Run" and newest["date_day"].year == 2025
    per_day = ask("How many exercise sessions per day in March 2025?").collect()
    assert [r["date_day"] for r in per_day] == sorted(r["date_day"] for r in per_day)
    assert sum(r["activity_count"] for r in per_day) == ask("how many exercise sessions in March 2025").first()["count"]
