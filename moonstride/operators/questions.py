"""Questions in plain words, read by rules into a date scope, a category and an intent.

All rules are column expressions, so a table of questions is read in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moonstride.functions.text import month_number
from moonstride.operators import filters
from moonstride.operators.counts import day_counts
from moonstride.operators.summary import count_per, count_where, latest
from moonstride.session import stage

# Words that name a category, tried in this order, and the source's own names.
CATEGORY_WORDS = (
    ("Run", ("run",)),
    ("Ride", ("ride", "cycling", "bike")),
    ("Swim", ("swim",)),
    ("Hike", ("hike", "hiking")),
    ("Walk", ("walk",)),
    ("Yoga", ("yoga",)),
    ("WeightTraining", ("weight", "strength")),
)
SPORT_WORDS = ("sport", "exercise")

# The fact stores aligned names, so questions look for those.
ALIGNED_NAMES = {"Ride": "Cycling", "Hike": "Hiking", "Walk": "Commuting"}

LIST_ROWS = 50
DEFAULT_ROWS = 10

_WORD = r"[\p{L}\p{N}_]+"
_IN_MONTH_YEAR = rf"in\s+({_WORD})\s+(\d{{4}})"
_IN_MONTH = rf"in\s+({_WORD})(?:\s|$)"
_IN_MONTH_MARK = rf"in\s+({_WORD})[?!.,;:]"
_IN_YEAR = r"(?:in|during)\s+(\d{4})"
_LAST_DAYS = r"(?:last|past)\s+(\d+)\s+days?"


# dates before this one are not told apart
FIRST_DATE = "0001-01-01"


def _days_before(as_of: Column, days: Column) -> Column:
    """``as_of`` less ``days``, but not before ``FIRST_DATE``."""
    first = F.lit(FIRST_DATE).cast("date")
    return F.date_sub(as_of, F.least(days, F.date_diff(as_of, first)))


def with_date_scope(
    questions: DataFrame, text: str = "question", as_of: Column | None = None, strict: bool = False
) -> DataFrame:
    """Add ``scope``: struct (kind, start, end, month, days) of the dates asked about, or null.

    ``end`` is exclusive. Tried in order: month of a year, month of any year, year, last N
    days, this month, this year. ``strict`` wants a blank or the end after a lone month;
    otherwise "in March?" is read as well.
    """
    as_of = F.current_date() if as_of is None else as_of
    lowered = F.lower(text)

    def word(pattern: str, group: int = 1) -> Column:
        return F.regexp_extract(lowered, pattern, group)

    def days_back() -> Column:
        # the plain search is the cheaper one and settles most texts
        return F.when(lowered.contains("last") | lowered.contains("past"), word(_LAST_DAYS)).otherwise("")

    # the patterns run once per text, in a projection of their own
    found = questions.select(
        "*",
        word(_IN_MONTH_YEAR).alias("_named"),
        word(_IN_MONTH_YEAR, 2).alias("_named_year"),
        word(_IN_MONTH).alias("_lone"),
        (F.lit("") if strict else word(_IN_MONTH_MARK)).alias("_marked"),
        word(_IN_YEAR).alias("_year"),
        days_back().alias("_days"),
        lowered.contains("this month").alias("_this_month"),
        lowered.contains("this year").alias("_this_year"),
    )
    # a failing try_cast costs an exception, so only texts of digits reach it
    found = found.withColumns(
        {
            **{
                number: F.when(F.col(number) != "", F.col(number)).try_cast("int")
                for number in ("_named_year", "_year")
            },
            # a number that no int holds reaches back to the first date
            "_days": F.when(
                F.col("_days") != "", F.coalesce(F.col("_days").try_cast("int"), F.lit(2**31 - 1))
            ),
            "_named_month": month_number(F.col("_named")),
            "_lone_month": F.when(
                F.col("_named") == "",
                F.coalesce(month_number(F.col("_lone")), month_number(F.col("_marked"))),
            ),
        }
    )
    month_start = F.make_date("_named_year", "_named_month", F.lit(1))
    year_start = F.make_date("_year", F.lit(1), F.lit(1))
    this_month, this_year = F.trunc(as_of, "MM"), F.trunc(as_of, "YYYY")

    def scope(kind: str, start=None, end=None, month=None, count=None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            (F.lit(None) if start is None else start).cast("date").alias("start"),
            (F.lit(None) if end is None else end).cast("date").alias("end"),
            (F.lit(None) if month is None else month).cast("int").alias("month"),
            (F.lit(None) if count is None else count).cast("int").alias("days"),
        )

    chosen = (
        F.when(
            F.col("_named_month").isNotNull(),
            scope("month_of_year", month_start, F.add_months(month_start, 1)),
        )
        .when(F.col("_lone_month").isNotNull(), scope("month", month=F.col("_lone_month")))
        .when(F.col("_year").isNotNull(), scope("year", year_start, F.add_months(year_start, 12)))
        .when(
            F.col("_days").isNotNull(),
            scope("last_days", _days_before(as_of, F.col("_days")), count=F.col("_days")),
        )
        .when(F.col("_this_month"), scope("this_month", this_month, F.add_months(this_month, 1)))
        .when(F.col("_this_year"), scope("this_year", this_year, F.add_months(this_year, 12)))
    )
    return found.select(*questions.columns, chosen.alias("scope"))


def _mentions(text: Column, words: tuple[str, ...], strict: bool) -> Column:
    anywhere = reduce(lambda a, b: a | b, (text.contains(word) for word in words))
    # the plain search is the cheaper one and settles most texts
    return anywhere if strict else anywhere & text.rlike(f"(^|[^a-z])({'|'.join(words)})")


def category(question: Column, strict: bool = False) -> Column:
    """Struct (activity_name, is_sport_exercise) a question asks about; null if none.

    A word must start a word of the question ("brunch" is no run) and names are the aligned
    ones of the fact. ``strict`` matches anywhere and gives the source's own names.
    """
    text = F.lower(question)

    def found(name: str | None, flag: bool | None) -> Column:
        return F.struct(
            F.lit(name).cast("string").alias("activity_name"),
            F.lit(flag).cast("boolean").alias("is_sport_exercise"),
        )

    rules = [
        (_mentions(text, words, strict), found(name if strict else ALIGNED_NAMES.get(name, name), None))
        for name, words in CATEGORY_WORDS
    ]
    rules.append((_mentions(text, SPORT_WORDS, strict), found(None, True)))
    (condition, value), *others = rules
    chain = F.when(condition, value)
    for condition, value in others:
        chain = chain.when(condition, value)
    return chain


def intent(question: Column) -> Column:
    """``count``, ``count_per_day``, ``list`` (50 rows) or ``default`` (10 rows)."""
    text = F.lower(question)

    def says(*phrases: str) -> Column:
        return reduce(lambda a, b: a | b, (text.contains(p) for p in phrases))

    counting = says("how many", "count")
    return (
        F.when(counting & says("per day", "each day"), "count_per_day")
        .when(counting, "count")
        .when(says("list", "show", "what", "which"), "list")
        .otherwise("default")
    )


@dataclass(frozen=True)
class Reading:
    """What one question asks for."""

    intent: str
    start: date | None = None
    end: date | None = None
    month: int | None = None
    activity_name: str | None = None
    is_sport_exercise: bool | None = None


def read_question(
    spark: SparkSession, text: str, as_of: date | None = None, strict: bool = False
) -> Reading:
    """Read a single question with the same expressions that read a table of them."""
    today = None if as_of is None else F.lit(as_of)
    asked = spark.range(1).select(F.lit(text).alias("question"))
    question = F.col("question")
    row = (
        with_date_scope(asked, "question", today, strict)
        .select(intent(question).alias("intent"), "scope", category(question, strict).alias("category"))
        .first()
    )
    scope, kind = row["scope"], row["category"]
    return Reading(
        intent=row["intent"],
        start=scope and scope["start"],
        end=scope and scope["end"],
        month=scope and scope["month"],
        activity_name=kind and kind["activity_name"],
        is_sport_exercise=kind and kind["is_sport_exercise"],
    )


def _asked_for(rows: DataFrame, reading: Reading, day: str) -> DataFrame:
    if reading.start is not None:
        rows = rows.where(F.col(day) >= F.lit(reading.start))
    if reading.end is not None:
        rows = rows.where(F.col(day) < F.lit(reading.end))
    if reading.month is not None:
        rows = rows.where(filters.in_months(day, reading.month))
    if reading.activity_name is not None:
        rows = rows.where(F.col("activity_name") == reading.activity_name)
    if reading.is_sport_exercise is not None:
        rows = rows.where(F.col("is_sport_exercise") == F.lit(reading.is_sport_exercise))
    return rows


def answer(fact: DataFrame, reading: Reading, tie_breaker: str, day: str = "date_day") -> DataFrame:
    """The rows or counts of ``fact`` that a reading asks for."""
    rows = _asked_for(fact, reading, day)
    if reading.intent == "count":
        return count_where(rows)
    if reading.intent == "count_per_day":
        return count_per(rows, day)
    return latest(rows, day, tie_breaker, LIST_ROWS if reading.intent == "list" else DEFAULT_ROWS)


def answer_from_counts(counts: DataFrame, reading: Reading) -> DataFrame:
    """What ``answer`` says to a counting question, from the table of ``counts.day_counts``; no fact row is read."""
    rows, number = _asked_for(counts, reading, "date_day"), F.sum("n")
    if reading.intent == "count":
        return rows.agg(F.coalesce(number, F.lit(0)).alias("count"))
    if reading.intent == "count_per_day":
        return rows.groupBy("date_day").agg(number.alias("activity_count")).orderBy(F.asc_nulls_last("date_day"))
    raise ValueError(f"counts cannot answer a question for rows ({reading.intent})")


def _filter_keys() -> Column:
    """The filters a fact row passes: everything, its name, and the sport flag if set."""
    keys = F.array(
        F.lit("all"),
        F.concat(F.lit("name:"), F.col("activity_name")),
        F.when(F.col("is_sport_exercise"), F.lit("sport")),
    )
    return F.array_compact(keys)


def count_answers(
    questions: DataFrame, fact: DataFrame, text: str = "question", as_of: Column | None = None
) -> DataFrame:
    """Answer every counting question of a table: its columns, the reading, and ``answer``.

    The fact is counted once per day and filter. Running totals of these counts turn each
    date range into the difference of two totals, found by equality joins; questions and
    facts never meet row by row. The totals have a row per day and filter name.
    """
    return count_answers_from(questions, day_counts(fact), text, as_of)


def count_answers_from(
    questions: DataFrame, per_day: DataFrame, text: str = "question", as_of: Column | None = None
) -> DataFrame:
    """``count_answers`` from a stored table of ``counts.day_counts``."""
    daily = stage(
        per_day.select("date_day", "n", F.explode(_filter_keys()).alias("filter_key"))
        .groupBy("filter_key", "date_day")
        .agg(F.sum("n").alias("n")),
        "daily-counts",
    )
    dated = daily.where(F.col("date_day").isNotNull())
    spans = dated.groupBy("filter_key").agg(
        F.min("date_day").alias("first_day"), F.date_add(F.max("date_day"), 1).alias("past_day")
    )
    before = Window.partitionBy("filter_key").orderBy("date_day").rowsBetween(Window.unboundedPreceding, -1)
    # totals[filter, d]: rows before day d, for every d from the first day to the day past the last
    totals = stage(
        spans.select("filter_key", F.explode(F.sequence("first_day", "past_day")).alias("date_day"))
        .join(dated, ["filter_key", "date_day"], "left")
        .select("filter_key", "date_day", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
        "running-counts",
    )
    months = dated.groupBy("filter_key", F.month("date_day").alias("month")).agg(F.sum("n").alias("in_month"))
    whole = daily.groupBy("filter_key").agg(
        F.sum("n").alias("in_all"),
        F.min("date_day").alias("first_day"),
        F.date_add(F.max("date_day"), 1).alias("past_day"),
    )

    kind = F.col("_category")
    counting = questions.where(intent(F.col(text)) == "count")
    read = (
        with_date_scope(counting, text, as_of)
        .withColumn("_category", category(F.col(text)))
        .withColumn(
            "filter_key",
            F.when(kind.isNull(), "all")
            .when(kind["is_sport_exercise"], "sport")
            .otherwise(F.concat(F.lit("name:"), kind["activity_name"])),
        )
        .drop("_category")
    )
    bounded = read.join(whole, "filter_key", "left").select(
        *[c for c in read.columns if c != "filter_key"],
        "filter_key",
        "in_all",
        F.col("scope.month").alias("month"),
        # a range outside the known days counts from or up to their edge
        F.least(F.greatest(F.col("scope.start"), F.col("first_day")), F.col("past_day")).alias("_from"),
        F.least(F.greatest(F.coalesce("scope.end", "past_day"), F.col("first_day")), F.col("past_day")).alias(
            "_to"
        ),
    )

    def total_before(bound: str) -> DataFrame:
        return totals.select("filter_key", F.col("date_day").alias(bound), F.col("before").alias(f"{bound}_n"))

    counted = (
        bounded.join(total_before("_from"), ["filter_key", "_from"], "left")
        .join(total_before("_to"), ["filter_key", "_to"], "left")
        .join(months, ["filter_key", "month"], "left")
    )
    count = (
        F.when(F.col("scope.start").isNotNull(), F.col("_to_n") - F.col("_from_n"))
        .when(F.col("month").isNotNull(), F.col("in_month"))
        .otherwise(F.col("in_all"))
    )
    return counted.select(
        *questions.columns,
        F.col("scope.kind").alias("scope_kind"),
        "filter_key",
        F.coalesce(count, F.lit(0)).alias("answer"),
    )
