"""A bigram language model with Good-Turing discounts and Katz backoff, trained and applied in place.

Counts are taken over key ranges of all training texts and stored by the task that asked for them:
words first, then pairs of words, then, per history, the mass its pairs leave over and what the
lower order would give to the same words. From these the backoff weight of a history is exact: over
all known words and the one unknown word, its probabilities add up to 1. Scoring follows the
recursion: a pair that was seen has its discounted share, any other backs off to the word, and an
unknown word gets what the discounts left over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moonstride.llm.census import Answers, Asked, blocks_of, census, fixed_scan, ranges_for, sums_of
from moonstride.llm.columns import pieces_of, utf8
from moonstride.llm.word_hashes import mix, words_of

# counts above this are not discounted
TRUSTED = 5
# keys of a range, so that whoever adds up their counts holds some tens of MB
RANGE_KEYS = 1 << 19
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)

_WEIGHT = np.dtype([("mass", "<f8"), ("low", "<f8"), ("seen", "<i8")])


@dataclass
class Discount:
    """What part of a count is kept, and how often counts add up to."""

    kept: np.ndarray  # by count, up to TRUSTED; 1 beyond

    @classmethod
    def good_turing(cls, having: np.ndarray) -> Discount:
        """``having[r]``: how many keys were counted r times, r up to TRUSTED + 1.

        Where the estimate is no proper share (few keys), half a count is taken off instead.
        """
        kept = np.ones(TRUSTED + 1)
        top = (TRUSTED + 1) * having[TRUSTED + 1] / having[1] if having[1] else 1.0
        for r in range(1, TRUSTED + 1):
            ratio = (r + 1) * having[r + 1] / (r * having[r]) if having[r] else 0.0
            share = (ratio - top) / (1 - top) if top < 1 else 0.0
            kept[r] = share if 0 < share < 1 else (r - 0.5) / r
        return cls(kept)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return counts * self.kept[np.where(counts <= TRUSTED, counts, 0)]


@dataclass
class Unigrams:
    total: float
    distinct: float
    discount: Discount
    divisor: float
    unknown: float

    @classmethod
    def of(cls, facts: np.ndarray) -> Unigrams:
        total, distinct, having = facts[0], facts[1], np.concatenate([[0], facts[2:]])
        discount = Discount.good_turing(having)
        few = np.arange(1, TRUSTED + 1)
        mass = total - (few * having[1 : TRUSTED + 1]).sum() + (few * discount.kept[1:] * having[1 : TRUSTED + 1]).sum()
        divisor = max(1.0, total if mass < total - 1e-9 else total + 1)
        return cls(total, distinct, discount, divisor, 1 - mass / divisor)

    def shares(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discount(counts) / self.divisor, self.unknown)


class Tokens:
    """The words of a block, each text closed by an end, with the hash of the word before."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        tokens, before, texts, row = [], [], [], 0
        for piece in pieces_of(batch, 2 << 20):
            words = words_of(*utf8(piece.column("text")))
            rows = len(words.bounds) - 1
            ends = words.bounds[1:]
            here = np.insert(words.hashes(lower=True), ends, END)
            past = np.empty_like(here)
            past[1:] = here[:-1]
            past[words.bounds[:-1] + np.arange(rows)] = START
            tokens.append(here)
            before.append(past)
            texts.append(np.repeat(np.arange(row, row + rows, dtype=np.int32), np.diff(words.bounds) + 1))
            row += rows
        self.tokens, self.before, self.texts, self.rows = np.concatenate(tokens), np.concatenate(before), np.concatenate(texts), row
        self.train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)[self.texts]

    def _asked(self, keys: np.ndarray) -> tuple[Asked, np.ndarray]:
        distinct, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, weights=self.train, minlength=len(distinct)).astype(np.int64)
        return Asked(distinct, counts=counts), place.astype(np.int32)  # a block has fewer than 2^31 words

    def ask_words(self) -> Asked:
        asked, self.word_at = self._asked(self.tokens)
        return asked

    def ask_pairs(self) -> Asked:
        asked, self.pair_at = self._asked(mix(self.before * np.uint64(0x9E3779B97F4A7C15) + mix(self.tokens)))
        self.example = np.zeros(len(asked.keys), np.int32)  # a place where each pair stands
        self.example[self.pair_at] = np.arange(len(self.tokens), dtype=np.int32)
        self.tokens = None  # no longer asked for
        return asked

    def learn_words(self, counts: np.ndarray, starts: int) -> None:
        self.count = counts[self.word_at]
        self.word_at = None  # no longer asked for
        self.before_count = np.empty_like(self.count)
        self.before_count[1:] = self.count[:-1]
        self.before_count[self.before == START] = starts

    def ask_histories(self, pairs: np.ndarray, unigrams: Unigrams, discount: Discount) -> Asked:
        """``pairs``: twice the count of each pair, plus 1 where this block answers for the pair."""
        mine = (pairs & 1).astype(bool) & (pairs > 1)
        known = np.flatnonzero(self.before_count > 0)
        histories, place = np.unique(self.before[known], return_inverse=True)
        self.history_at = np.full(len(self.before), -1, np.int32)
        self.history_at[known] = place
        values = np.zeros(len(histories), _WEIGHT)
        values["seen"][place] = self.before_count[known]
        at = self.example[mine]
        values["mass"] = np.bincount(self.history_at[at], weights=discount(pairs[mine] >> 1), minlength=len(histories))
        values["low"] = np.bincount(self.history_at[at], weights=unigrams.shares(self.count[at]), minlength=len(histories))
        return Asked(mix(histories), counts=values) if len(histories) < 2 else self._sorted(histories, values)

    def _sorted(self, histories: np.ndarray, values: np.ndarray) -> Asked:
        keys = mix(histories)
        order = np.argsort(keys)
        back = np.empty(len(order), np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        self.history_at = np.where(self.history_at >= 0, back[self.history_at], -1)
        return Asked(keys[order], counts=values[order])


def _having(totals: np.ndarray) -> list[int]:
    return [int((totals == r).sum()) for r in range(1, TRUSTED + 2)]


def _settle_words(counts: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    totals = np.bincount(key_of, weights=counts, minlength=n).astype(np.int64)
    return totals[key_of], {0: [totals.sum(), (totals > 0).sum(), *_having(totals)]}


def _settle_pairs(counts: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    totals = np.bincount(key_of, weights=counts, minlength=n).astype(np.int64)
    return 2 * totals[key_of] + first, {0: _having(totals)}


def _settle_histories(values: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    """Backoff weight of each history; negative if its pairs are divided by one more than its count."""
    mass, low = (np.bincount(key_of, weights=values[name], minlength=n) for name in ("mass", "low"))
    seen = np.zeros(n)
    seen[key_of] = values["seen"]
    more = mass >= seen - 1e-9
    weight = (1 - mass / (seen + more)) / np.maximum(1 - low, 1e-300)
    return np.where(more, -weight, weight)[key_of], {}


def in_training(learn_from: Column) -> Column:
    return F.coalesce(learn_from, F.lit(False)).alias("train")


def score_texts(docs: DataFrame, learn_from: Column) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``train``.

    ``learn_from`` says which rows to learn from (null: not). Tokens are words (A-Z in lower case; parted by
    blanks and the controls 9 to 13) and one end per text. ``score`` is log10 of the model's probability
    of the text, ``base_score`` that of words alone with half a count added. All words that training
    texts lack are one unknown word.

    Null and empty texts are an end alone. Repeated rows are learned and scored each time; ids are only handed
    on. Without training rows every word is unknown and has probability 1. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), in_training(learn_from))
    base = fixed_scan(rows)
    few, many = ranges_for(base, 1 / 60, RANGE_KEYS), ranges_for(base, 1 / 8, RANGE_KEYS)
    whole = np.dtype(np.int64)

    words = census(base, lambda batch, _: [Tokens(batch).ask_words()], _settle_words, few, whole)
    pairs = census(base, lambda batch, _: [Tokens(batch).ask_pairs()], _settle_pairs, many, whole)
    facts = sums_of(base, words).get(0)
    unigrams = Unigrams.of(facts if facts is not None else np.zeros(3 + TRUSTED))
    having = sums_of(base, pairs).get(0)
    discount = Discount.good_turing(np.concatenate([[0], having if having is not None else np.zeros(TRUSTED + 1)]))
    starts = base.where("train").count()

    def learned(batch: pa.RecordBatch, replies: list) -> tuple[Tokens, np.ndarray, Asked]:
        tokens = Tokens(batch)
        tokens.learn_words(replies[0].read([tokens.ask_words()], few, whole)[0], starts)
        found = replies[1].read([tokens.ask_pairs()], many, whole)[0]
        return tokens, found, tokens.ask_histories(found, unigrams, discount)

    weights = census(base, lambda batch, replies: [learned(batch, replies)[2]], _settle_histories, few, _WEIGHT, earlier=[words, pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies = None
        for block, batch in blocks_of(batches):
            task = TaskContext.get().partitionId()
            replies = replies or [Answers(path, task) for path in (words, pairs, weights)]
            told = [r.of(block) for r in replies]
            tokens, found, asked = learned(batch, told)
            weight = np.append(told[2].read([asked], few, np.float64)[0], 1.0)[tokens.history_at]  # last: unknown history
            count = (found >> 1)[tokens.pair_at]
            low = unigrams.shares(tokens.count)
            share = discount(count) / np.maximum(tokens.before_count + (weight < 0), 1)
            logs = np.log10(np.where(count > 0, np.where(count > 0, share, 1.0), np.abs(weight) * low))
            plain = np.log10((tokens.count + 0.5) / (unigrams.total + 0.5 * (unigrams.distinct + 1)))
            sums = [np.bincount(tokens.texts, weights=w, minlength=tokens.rows) for w in (np.ones(len(logs)), tokens.count > 0, plain, logs)]
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)),
                    pa.array(np.full(tokens.rows, int(unigrams.total))), pa.array(sums[2]), pa.array(sums[3]), batch.column("train"),
                ],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "train"],
            )

    return base.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, train boolean")
