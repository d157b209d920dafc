"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For every bit a binary classifier over hashed letter trigrams
says on which side a text lies; its weights are the log odds of a trigram among the languages with
the bit against those without. Decoding adds up, for every codeword, the losses of the bits, weighted
by how well a bit was told apart in training, and takes the codeword with the least loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moonstride.llm.columns import pieces_of, texts_of
from moonstride.llm.memories import forget_others
from moonstride.session import stage

DIMENSIONS = 1 << 16
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
# a-z and all bytes above 127 are read, A-Z as a-z, anything else as a blank
_READ = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
_PLACES = np.random.RandomState(9).randint(0, DIMENSIONS, (3, 256)).astype(np.uint16)


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, blanks around each text included, and where each text's begin."""
    lengths = np.array([len(t) for t in texts], np.int64)
    joined = _READ[np.frombuffer(b" ".join([b"", *texts, b" "]), np.uint8)]
    hashed = _PLACES[0][joined[:-2]] ^ _PLACES[1][joined[1:-1]] ^ _PLACES[2][joined[2:]]
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    keep = np.ones(len(hashed), bool)
    keep[(starts + lengths)[starts + lengths < len(hashed)]] = False  # across two texts
    keep[int((starts + lengths)[-1]) :] = False
    return hashed[keep], np.concatenate([[0], np.cumsum(lengths)])


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A codeword of -1 and 1 per language: all different ways to part up to five, else the best of random codes."""
    if languages <= 5:
        columns = range(1, 1 << max(0, languages - 1))
        return np.array([[1 if c >> row & 1 else -1 for c in columns] for row in range(languages)]).reshape(languages, -1)
    bits, random, best, distance = max(15, int(np.ceil(10 * np.log2(languages)))), np.random.RandomState(seed), None, -1
    for _ in range(100):
        code = random.choice([-1, 1], (languages, bits))
        apart = (bits - code @ code.T) // 2 + bits * np.eye(languages, dtype=int)
        mixed = np.abs(code.sum(axis=0)) < languages
        if mixed.all() and apart.min() > distance:
            best, distance = code, apart.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # trigrams x bits
    scale: np.ndarray  # usual size of a bit's margin
    trust: np.ndarray  # weight of a bit in decoding

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Mean log odds per text and bit; 0 for a text without trigrams."""
        hashed, starts = _trigrams(texts)
        out = np.zeros((len(texts), self.code.shape[1]))
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            sums = np.add.reduceat(self.weights[hashed], starts[full], axis=0, dtype=np.float64)
            out[full] = sums / np.diff(starts)[full, None]
        return out

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Share of every language: exp(-loss), made to sum to 1."""
        agreement = margins / self.scale * self.trust.clip(0)  # per bit
        losses = np.stack([np.log1p(np.exp(-4 * agreement * word)) @ self.trust for word in self.code], axis=1)
        losses -= losses.min(axis=1, keepdims=True)
        shares = np.exp(-losses)
        return shares / shares.sum(axis=1, keepdims=True)


def first_by_hash(ids: DataFrame, count: int) -> DataFrame:
    """Per ``lang`` the ``count``-th lowest pair of hash and id (the highest one where there are fewer), as ``last``.

    ``ids`` holds ``lang`` and ``at`` (struct of hash and id) and is read three times. A language may hold most
    rows: rows are first counted by the leading 12, then by the leading 24 bits of the hash, so that only
    those at or below the wanted place, some ``count`` of them, meet in one task.
    """
    near = ids
    for shift in (52, 40):
        step = F.shiftright(F.col("at.hash"), shift)
        counted = near.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
        so_far = F.sum("n").over(Window.partitionBy("lang").orderBy("step"))
        reached = counted.withColumn("so_far", so_far).groupBy("lang")
        limits = reached.agg(F.coalesce(F.min(F.when(F.col("so_far") >= count, F.col("step"))), F.max("step")).alias("limit"))
        limits = stage(limits, "hash-limits").withColumnRenamed("lang", "_lang")
        near = near.join(limits, F.col("lang") == F.col("_lang")).where(step <= F.col("limit")).select("lang", "at")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    return near.withColumn("_nth", nth).where(F.col("_nth") <= count).groupBy("lang").agg(F.max("at").alias("last"))


def fit(labelled: DataFrame, per_language: int = 2000, max_languages: int = 500) -> LanguageModel:
    """Learn from ``doc_id``, ``text``, ``lang``; rows without id, text or language are left out.

    At most ``per_language`` documents of a language are read, those with the lowest hash of their
    id; they are chosen from ids alone, before any text is read. More than ``max_languages``
    languages are an error. What reaches the driver are trigram counts per language, at most
    ``DIMENSIONS`` each.
    """
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    at = F.struct(F.xxhash64("doc_id").alias("hash"), F.col("doc_id").alias("id"))
    known = known.where(F.col("doc_id").isNotNull()).withColumn("at", at)
    last = stage(first_by_hash(stage(known.select("lang", "at"), "labelled-ids"), per_language), "last-ids")
    languages = sorted(r.lang for r in last.select("lang").limit(max_languages + 1).collect())
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not languages:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((DIMENSIONS, 0), np.float32), np.ones(0), np.ones(0))
    sample = known.join(last.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    sample = sample.where(F.col("at") <= F.col("last")).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others()
        counts: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in pieces_of(whole, 1 << 20):
                texts = [t.encode() for t in batch.column("text").to_pylist()]
                hashed, starts = _trigrams(texts)
                for i, lang in enumerate(batch.column("lang").to_pylist()):
                    held = counts.setdefault(lang, np.zeros(DIMENSIONS, np.int64))
                    held += np.bincount(hashed[starts[i] : starts[i + 1]], minlength=DIMENSIONS)
        for lang, held in counts.items():
            at = np.flatnonzero(held)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], ["lang", "place", "n"])

    rows = sample.mapInArrow(count, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), DIMENSIONS))
    row_of = {lang: i for i, lang in enumerate(languages)}
    rows_at = [row_of[lang] for lang in rows.column("lang").to_pylist()]
    counts[rows_at, rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    shares = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * DIMENSIONS)
    code = codewords(len(languages))
    odds = [np.log(shares[bit > 0].mean(axis=0)) - np.log(shares[bit < 0].mean(axis=0)) for bit in code.T]
    weights = np.array(odds).T.astype(np.float32).reshape(DIMENSIONS, -1)
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))
    if not code.shape[1]:
        return model

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others()
        n, right, size = 0, np.zeros(code.shape[1]), np.zeros(code.shape[1])
        for whole in batches:
            for batch in pieces_of(whole, 1 << 20):
                margins = model.margins([t.encode() for t in batch.column("text").to_pylist()])
                wanted = code[[row_of[lang] for lang in batch.column("lang").to_pylist()]]
                n, right, size = n + len(margins), right + (margins * wanted > 0).sum(axis=0), size + np.abs(margins).sum(axis=0)
        yield pa.record_batch([pa.array(range(len(right)), pa.int64()), pa.array([float(n)] * len(right)), pa.array(right), pa.array(size)], ["bit", "n", "right", "size"])

    sums = sample.mapInArrow(judge, "bit long, n double, right double, size double").groupBy("bit").agg(F.sum("n"), F.sum("right"), F.sum("size")).orderBy("bit").collect()
    model.trust = np.array([max(0.05, 2 * r[2] / r[1] - 1) for r in sums])
    model.scale = np.array([max(1e-6, r[3] / r[1]) for r in sums])
    return model


def identify(docs: DataFrame, model: LanguageModel, least_lead: float = 0.2, carry: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score`` (share of that language, 0 to 1), ``second``, ``ambiguous``.

    A null text, one without a letter, and any text if the model knows no language are ``und`` with score
    0. ``ambiguous`` says that the second language's share is less than ``least_lead`` behind. Only
    ``text`` is read; rows never meet and nothing is shuffled. Repeated rows give repeated results; an
    empty table gives none. ``carry`` adds the whole row as ``row``.
    """
    rows = texts_of(docs, carry=carry)
    kinds = T.StructType([f for f in rows.schema.fields if f.name != "text"]).add("lang_pred", "string").add("score", "double")
    kinds = kinds.add("second", "string").add("ambiguous", "boolean")
    names = kinds.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others()
        for whole in batches:
            for batch in pieces_of(whole, 1 << 20):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                best, score, second, doubt = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts), [False] * len(texts)
                lettered = [i for i, t in enumerate(texts) if _LETTER.search(t)] if model.languages else []
                if lettered:
                    shares = model.decode(model.margins([texts[i].encode() for i in lettered]))
                    order = np.argsort(-shares, axis=1, kind="stable")
                    for i, row, ranked in zip(lettered, shares, order):
                        best[i], score[i] = model.languages[ranked[0]], float(row[ranked[0]])
                        if len(ranked) > 1:
                            second[i] = model.languages[ranked[1]]
                            doubt[i] = bool(row[ranked[0]] - row[ranked[1]] < least_lead)
                made = {"lang_pred": pa.array(best, pa.string()), "score": pa.array(score, pa.float64()), "second": pa.array(second, pa.string()), "ambiguous": pa.array(doubt, pa.bool_())}
                yield pa.record_batch([made[n] if n in made else batch.column(n) for n in names], names)

    return rows.mapInArrow(run, kinds)
