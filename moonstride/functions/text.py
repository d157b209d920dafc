"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of the months.
MONTH_SPELLINGS = {
    "january": 1, "jan": 1,
    "february": 2, "feb": 2,
    "march": 3, "mar": 3,
    "april": 4, "apr": 4,
    "may": 5,
    "june": 6, "jun": 6,
    "july": 7, "jul": 7,
    "august": 8, "aug": 8,
    "september": 9, "sep": 9, "sept": 9,
    "october": 10, "oct": 10,
    "november": 11, "nov": 11,
    "december": 12, "dec": 12,
}


def month_number(name: Column) -> Column:
    """Month name or abbreviation in any case to 1..12; null for anything else."""
    entries = [F.lit(part) for pair in MONTH_SPELLINGS.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), F.lower(name))


def same_text(left: Column, right: Column) -> Column:
    """Equality after trimming and case folding."""
    return F.lower(F.trim(left)) == F.lower(F.trim(right))


def strip_code_fence(text: Column) -> Column:
    """Drop fence markers at line starts, outer blanks and outer quotes."""
    bare = F.regexp_replace(text, r"(?md)^```sql\s*", "")
    bare = F.regexp_replace(bare, r"(?md)^```\s*", "")
    for outer in (" \t\n\x0b\f\r", '"', "'"):
        bare = F.btrim(bare, F.lit(outer))
    return bare


def strip_inline_markup(text: Column) -> Column:
    """Drop bold stars and code ticks but keep what they enclose."""
    plain = F.regexp_replace(text, r"\*\*([^*]+)\*\*", "$1")
    return F.regexp_replace(plain, r"`([^`]+)`", "$1")
