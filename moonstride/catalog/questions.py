"""Questions in plain words. Their texts are made from the orders, one per row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.catalog.registry import Tables, query
from moonstride.functions.text import MONTH_SPELLINGS
from moonstride.operators import questions as q
from moonstride.operators.counts import day_counts, refreshed_counts
from moonstride.session import stage

AS_OF = date(2001, 7, 15)

# one text per remainder of the order key; {words} is what is asked for
_TEMPLATES = (
    "How many {words} did I do in {month} {year}?",
    "How many {words} in {month}?",
    "How many {words} in {short} so far",
    "how many {words} during {year}",
    "Count my {words} from the last {days} days",
    "How many {words} this month",
    "How many {words} this year?",
    "How many {words}?",
    "How many {words} per day in {month} {year}",
    "List {words} in {year}",
    "Was there brunch within {month} {year}? Count the walks",
    "Tell me about swimming in the sea, {month}",
)


def question_texts(orders: DataFrame) -> DataFrame:
    """order id and a question whose dates come from the order."""
    day = F.col("o_orderdate").cast("date")
    words = (
        F.when(F.col("o_orderstatus") == "F", "runs")
        .when(F.col("o_orderstatus") == "O", "bike rides")
        .otherwise("exercise sessions")
    )
    parts = {
        "words": words,
        "month": F.date_format(day, "MMMM"),
        "short": F.date_format(day, "MMM"),
        "year": F.year(day).cast("string"),
        "days": (F.col("o_orderkey") % 400 + 1).cast("string"),
    }
    text = F.element_at(F.array(*map(F.lit, _TEMPLATES)), (F.col("o_orderkey") % len(_TEMPLATES) + 1).cast("int"))
    for name, part in parts.items():
        text = F.replace(text, F.lit(f"{{{name}}}"), part)
    return orders.select("o_orderkey", text.alias("question"))


def _templates_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(_TEMPLATES))
    text = f"CASE o_orderkey % {len(_TEMPLATES)} {cases} END"
    parts = {
        "words": "CASE o_orderstatus WHEN 'F' THEN 'runs' WHEN 'O' THEN 'bike rides' ELSE 'exercise sessions' END",
        "month": "strftime(o_orderdate, '%B')",
        "short": "strftime(o_orderdate, '%b')",
        "year": "strftime(o_orderdate, '%Y')",
        "days": "CAST(o_orderkey % 400 + 1 AS VARCHAR)",
    }
    for name, part in parts.items():
        text = f"replace({text}, '{{{name}}}', {part})"
    return text


QUESTION_SQL = f"(SELECT o_orderkey, {_templates_sql()} AS question FROM orders)"

def _month_sql(word: str) -> str:
    cases = " ".join(f"WHEN '{spelling}' THEN {number}" for spelling, number in MONTH_SPELLINGS.items())
    return f"CASE {word} {cases} END"


_W = r"[\p{L}\p{N}_]+"
SCOPE_SQL = f"""(
    SELECT *, CASE WHEN kind IN ('month_of_year') THEN make_date(named_year, named_month, 1)
                   WHEN kind = 'year' THEN make_date(lone_year, 1, 1)
                   WHEN kind = 'last_days' THEN CAST(DATE '{AS_OF}' - CAST(days_back AS INTEGER) AS DATE)
                   WHEN kind = 'this_month' THEN CAST(date_trunc('month', DATE '{AS_OF}') AS DATE)
                   WHEN kind = 'this_year' THEN CAST(date_trunc('year', DATE '{AS_OF}') AS DATE) END AS start
    FROM (SELECT *, CASE WHEN named_month IS NOT NULL THEN 'month_of_year'
                         WHEN lone_month IS NOT NULL AND named_word = '' THEN 'month'
                         WHEN lone_year IS NOT NULL THEN 'year'
                         WHEN days_back IS NOT NULL THEN 'last_days'
                         WHEN contains(text, 'this month') THEN 'this_month'
                         WHEN contains(text, 'this year') THEN 'this_year' END AS kind
          FROM (SELECT *, {_month_sql("named_word")} AS named_month,
                       coalesce({_month_sql("lone_word")}, {_month_sql("marked_word")}) AS lone_month
                FROM (SELECT *, lower(question) AS text,
                        regexp_extract(lower(question), 'in\\s+({_W})\\s+(\\d{{4}})', 1) AS named_word,
                        TRY_CAST(regexp_extract(lower(question), 'in\\s+({_W})\\s+(\\d{{4}})', 2) AS INTEGER)
                            AS named_year,
                        regexp_extract(lower(question), 'in\\s+({_W})(?:\\s|$)', 1) AS lone_word,
                        regexp_extract(lower(question), 'in\\s+({_W})[?!.,;:]', 1) AS marked_word,
                        TRY_CAST(regexp_extract(lower(question), '(?:in|during)\\s+(\\d{{4}})', 1) AS INTEGER)
                            AS lone_year,
                        TRY_CAST(regexp_extract(lower(question), '(?:last|past)\\s+(\\d+)\\s+days?', 1) AS INTEGER)
                            AS days_back
                      FROM {QUESTION_SQL} q) a) b) c)"""
_END_SQL = """CAST(CASE kind WHEN 'month_of_year' THEN start + INTERVAL '1 month'
    WHEN 'year' THEN start + INTERVAL '1 year' WHEN 'this_month' THEN start + INTERVAL '1 month'
    WHEN 'this_year' THEN start + INTERVAL '1 year' END AS DATE)"""


def _category_sql(text: str) -> str:
    rules = (
        ("Run", "run"), ("Cycling", "ride|cycling|bike"), ("Swim", "swim"), ("Hiking", "hike|hiking"),
        ("Commuting", "walk"), ("Yoga", "yoga"), ("WeightTraining", "weight|strength"), ("sport", "sport|exercise"),
    )
    cases = " ".join(f"WHEN regexp_matches(lower({text}), '(^|[^a-z])({words})') THEN '{name}'" for name, words in rules)
    return f"CASE {cases} END"


_INTENT_SQL = """CASE
    WHEN contains(lower({0}), 'how many') OR contains(lower({0}), 'count') THEN
        CASE WHEN contains(lower({0}), 'per day') OR contains(lower({0}), 'each day')
             THEN 'count_per_day' ELSE 'count' END
    WHEN contains(lower({0}), 'list') OR contains(lower({0}), 'show') OR contains(lower({0}), 'what')
         OR contains(lower({0}), 'which') THEN 'list'
    ELSE 'default' END"""


@query(f"""
    SELECT o_orderkey, question, kind, start, {_END_SQL} AS past_end,
           CASE WHEN kind = 'month' THEN lone_month END AS month,
           CASE WHEN kind = 'last_days' THEN days_back END AS days
    FROM {SCOPE_SQL} s""")
def qn_date_scope(t: Tables) -> DataFrame:
    """The dates each question asks about."""
    read = q.with_date_scope(question_texts(t.orders), "question", F.lit(AS_OF))
    return read.select(
        "o_orderkey",
        "question",
        "scope.kind",
        "scope.start",
        F.col("scope.end").alias("past_end"),
        "scope.month",
        "scope.days",
    )


@query(f"""
    SELECT o_orderkey, nullif(found, 'sport') AS activity_name,
           CASE WHEN found = 'sport' THEN true END AS is_sport_exercise
    FROM (SELECT o_orderkey, {_category_sql("question")} AS found FROM {QUESTION_SQL} t) c""")
def qn_category(t: Tables) -> DataFrame:
    """What each question asks for."""
    found = question_texts(t.orders).withColumn("found", q.category(F.col("question")))
    return found.select("o_orderkey", "found.activity_name", "found.is_sport_exercise")


@query(f"""
    SELECT conv_id, turn, role, {_INTENT_SQL.format("text")} AS intent, {_category_sql("text")} AS category
    FROM conversations""")
def qn_intent(t: Tables) -> DataFrame:
    """How to answer what is said in conversations, and the category it names."""
    found = q.category(F.col("text"))
    name = F.when(found["is_sport_exercise"], "sport").otherwise(found["activity_name"])
    return t.conversations.select("conv_id", "turn", "role", q.intent(F.col("text")).alias("intent"), name.alias("category"))


def order_activities(orders: DataFrame) -> DataFrame:
    """Orders as activities: the priority decides name and sport flag; one priority has neither."""
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority.isin("1-URGENT", "5-LOW"), "Run")
        .when(priority == "2-HIGH", "Cycling")
        .when(priority == "3-MEDIUM", "Commuting")
    )
    return orders.select(
        F.col("o_orderkey").alias("activity_id"),
        F.col("o_orderdate").cast("date").alias("date_day"),
        name.alias("activity_name"),
        F.when(name.isNotNull(), name != "Commuting").alias("is_sport_exercise"),
    )


_ORDER_ACTIVITY_SQL = """(
    SELECT activity_id, date_day, activity_name, activity_name <> 'Commuting' AS is_sport_exercise
    FROM (SELECT o_orderkey AS activity_id, CAST(o_orderdate AS DATE) AS date_day,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'Run' WHEN '5-LOW' THEN 'Run'
                     WHEN '2-HIGH' THEN 'Cycling' WHEN '3-MEDIUM' THEN 'Commuting' END AS activity_name
          FROM orders) o)"""


def _ask(t: Tables, fact: DataFrame, text: str, tie_breaker: str, as_of: date) -> DataFrame:
    return q.answer(fact, q.read_question(t.spark, text, as_of), tie_breaker)


@query(f"""
    SELECT count(*) AS count FROM {_ORDER_ACTIVITY_SQL} a
    WHERE activity_name = 'Run' AND date_day >= DATE '1998-12-01' AND date_day < DATE '1999-01-01'""")
def qn_count_month(t: Tables) -> DataFrame:
    return _ask(t, order_activities(t.orders), "How many runs in December 1998?", "activity_id", AS_OF)


@query(f"""
    SELECT date_day, count(*) AS activity_count FROM {_ORDER_ACTIVITY_SQL} a
    WHERE is_sport_exercise AND extract(month FROM date_day) = 3 GROUP BY 1 ORDER BY 1""")
def qn_per_day(t: Tables) -> DataFrame:
    return _ask(t, order_activities(t.orders), "How many sport sessions per day in March?", "activity_id", AS_OF)


def _stored_counts(t: Tables) -> DataFrame:
    """Counts of the orders, the later half of every month loaded afterwards."""
    fact = order_activities(t.orders)
    late = fact.where(F.dayofmonth("date_day") > 15)
    stored = stage(day_counts(fact.where(F.dayofmonth("date_day") <= 15)), "day-counts")
    return stage(refreshed_counts(stored, fact, late.select("date_day")), "day-counts")


@query(f"""
    SELECT date_day, count(*) AS activity_count FROM {_ORDER_ACTIVITY_SQL} a
    WHERE is_sport_exercise AND extract(month FROM date_day) = 3 GROUP BY 1 ORDER BY 1""")
def qn_per_day_stored(t: Tables) -> DataFrame:
    """The same from stored counts that took in late rows."""
    reading = q.read_question(t.spark, "How many sport sessions per day in March?", AS_OF)
    return q.answer_from_counts(_stored_counts(t), reading)


@query(f"""
    SELECT count(*) AS count FROM {_ORDER_ACTIVITY_SQL} a
    WHERE activity_name = 'Run' AND date_day >= DATE '1998-12-01' AND date_day < DATE '1999-01-01'""")
def qn_count_month_stored(t: Tables) -> DataFrame:
    """The same from stored counts that took in late rows."""
    return q.answer_from_counts(_stored_counts(t), q.read_question(t.spark, "How many runs in December 1998?", AS_OF))


@query(f"""
    SELECT * FROM {_ORDER_ACTIVITY_SQL} a
    WHERE activity_name = 'Cycling' AND date_day >= DATE '{AS_OF}' - 400
    ORDER BY date_day DESC, activity_id DESC LIMIT 50""")
def qn_latest(t: Tables) -> DataFrame:
    text = "Which bike tours did I do in the last 400 days"
    return _ask(t, order_activities(t.orders), text, "activity_id", AS_OF)


@query(f"""
    WITH asked AS (
        SELECT o_orderkey, question, kind AS scope_kind, start, {_END_SQL} AS past_end,
               CASE WHEN kind = 'month' THEN lone_month END AS month, {_category_sql("question")} AS found
        FROM {SCOPE_SQL} s WHERE {_INTENT_SQL.format("question")} = 'count'),
    specs AS (SELECT DISTINCT start, past_end, month, found FROM asked),
    daily AS (SELECT date_day, activity_name, is_sport_exercise, count(*) AS n
              FROM {_ORDER_ACTIVITY_SQL} a GROUP BY ALL),
    answers AS (
        SELECT s.start, s.past_end, s.month, s.found, CAST(coalesce(sum(d.n), 0) AS BIGINT) AS answer
        FROM specs s LEFT JOIN daily d
          ON (s.start IS NULL OR d.date_day >= s.start) AND (s.past_end IS NULL OR d.date_day < s.past_end)
         AND (s.month IS NULL OR extract(month FROM d.date_day) = s.month)
         AND (s.found IS NULL OR d.activity_name = s.found OR (s.found = 'sport' AND d.is_sport_exercise))
        GROUP BY ALL)
    SELECT a.o_orderkey, a.question, a.scope_kind,
           CASE WHEN a.found IS NULL THEN 'all' WHEN a.found = 'sport' THEN 'sport' ELSE 'name:' || a.found END
               AS filter_key, w.answer
    FROM asked a JOIN answers w ON a.start IS NOT DISTINCT FROM w.start
      AND a.past_end IS NOT DISTINCT FROM w.past_end AND a.month IS NOT DISTINCT FROM w.month
      AND a.found IS NOT DISTINCT FROM w.found""")
def qn_batch_counts(t: Tables) -> DataFrame:
    """Answer every counting question of a stored table in one job."""
    asked = stage(question_texts(t.orders), "questions")
    return q.count_answers(asked, order_activities(t.orders), as_of=F.lit(AS_OF))
