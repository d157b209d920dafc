"""Column expressions shared by the models. None of them is a UDF."""

from moonstride.functions.measures import (
    as_decimal2,
    as_integer,
    hours_from_minutes,
    hours_from_seconds,
    kilometers,
    kilometers_per_hour,
    minutes_from_millis,
    minutes_from_seconds,
    minutes_to_hhmm,
)
from moonstride.functions.text import month_number, same_text, strip_code_fence, strip_inline_markup
from moonstride.functions.times import (
    day_of,
    minutes_crossed,
    night_date,
    weekday_number,
)

__all__ = [
    "as_decimal2",
    "as_integer",
    "day_of",
    "hours_from_minutes",
    "hours_from_seconds",
    "kilometers",
    "kilometers_per_hour",
    "minutes_crossed",
    "minutes_from_millis",
    "minutes_from_seconds",
    "minutes_to_hhmm",
    "month_number",
    "night_date",
    "same_text",
    "strip_code_fence",
    "strip_inline_markup",
    "weekday_number",
]
