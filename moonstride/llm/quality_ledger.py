"""Quality rules as a ledger of measurements and failure bits.

Every rule is evaluated once per text and leaves a bit, next to what was measured. Policies are masks
over the bits, so a new version of a policy, or the same one without a rule, needs no text at all.
The ledger is written once and policies read it: a filter on a verdict reaches the stored bits and never
the measuring. All of it is DataFrame functions on single rows: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moonstride.session import stage

WINDOW = 5
_GAP = r"[\x20\x09-\x0D]+"
_SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurements; ``bit`` is the rule's place for good."""

    name: str
    bit: int
    fails: Callable[[], Column]


RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 10),
    Rule("repeated_words", 1, lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("many_symbols", 2, lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule("repeated_lines", 3, lambda: 10 * F.col("n_dup_lines") > 4 * F.col("n_full_lines")),
    Rule("short_words", 4, lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", 5, lambda: F.col("word_chars") > 20 * F.col("n_words")),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = Policy("prose", 1, tuple(r.name for r in RULES))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_full_lines``, ``n_repeat_words``.

    A window of ``WINDOW`` words counts as repeated if its 64-bit hash stands at two places of the text.
    The places are only sorted out for texts where there are fewer distinct windows than windows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, _GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"), lines.alias("lines"),
        F.regexp_count(text, F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
    )
    long = lambda column: column.cast("long")
    # a column that a lambda reads is read outside it too, so that it is computed once and not per element
    step = step.select(
        "doc_id", "n_symbols",
        long(F.size("words")).alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)).alias("word_chars"),
        long(F.size("lines")).alias("n_full_lines"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    measured = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_full_lines"]
    starts = F.when(F.size("hashes") >= WINDOW, F.sequence(F.lit(0), F.size("hashes") - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW))))
    step = step.select(*measured, windows.alias("windows"))
    again = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.select(*measured, F.when(again, placed).alias("placed"))
    alike = lambda s, other: F.coalesce(s["h"] == F.get("placed", other)["h"], F.lit(False))
    twice = F.filter("placed", lambda s, i: alike(s, i - 1) | alike(s, i + 1))
    step = step.select(*measured, F.array_sort(F.transform(twice, lambda s: s["i"])).alias("places"), F.size("placed").alias("_n"))
    new = F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1), p + WINDOW) - p))
    covered = F.aggregate(new, F.lit(0).cast("long"), lambda n, x: n + x)
    return step.select(*measured, F.when(F.size("places") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def build_ledger(docs: DataFrame) -> DataFrame:
    """The stored measurements of every row, and ``failures``: bit ``rule.bit`` is set where that rule fails.

    The ledger is a table in the shared folder (a few numbers per text); ``session.release`` removes it.

    Words are parted by blanks and the controls 9 to 13. Null and empty texts have no words and fail
    ``few_words`` alone. Rows never meet: ids are handed on, null or repeated as they are, repeated
    rows give repeated entries, an empty table gives none, other columns are not read.
    """
    bits = [F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long") for rule in RULES]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return stage(measure(docs).withColumn("failures", failures), "ledger")


def fails(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(ledger: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy fails."""
    return ledger.withColumn("kept", ~fails(policy))


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: ``failed`` texts, those failed by it ``alone``, and ``kept_without`` it.

    Texts are first counted by their bits under the policy's mask, of which there are few, and the
    rules are read off those counts.
    """
    counted = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = [r for r in RULES if r.name in policy.rules]
    each = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules)))
    rows = counted.select("bits", "n", each.alias("r"))
    has = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))
    bits, bit = F.col("bits"), F.col("r.bit")
    return rows.groupBy(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule")).agg(
        has(bits.bitwiseAND(bit) != 0).alias("failed"),
        has(bits == bit).alias("alone"),
        has((bits == 0) | (bits == bit)).alias("kept_without"),
    )
