"""Finding benchmark passages in documents with one Aho-Corasick automaton.

Both sides are normalised alike: A-Z in lower case, every other character below U+0080 that is
no digit or letter read as a gap between words. The automaton holds all windows of the items and
reads a document's normalised text once; what it finds is mapped back to places in the original.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moonstride.llm.columns import texts_of
from moonstride.llm.memories import forget_others
from moonstride.session import stage

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_AUTOMATA: dict[tuple, ahocorasick.Automaton] = {}

_RANGES = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_RANGES_TYPE = T.ArrayType(T.StructType().add("first", "long").add("last", "long"))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_TABLE).split()


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct ``window`` (words with a blank before and after each), ``words`` and ``item`` (its id as text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                n = min(size, len(words))
                for first in range(0, len(words) - n + 1 if n else 0, 1000):
                    found = [b" " + b" ".join(words[i : i + n]) + b" " for i in range(first, min(first + 1000, len(words) - n + 1))]
                    yield pa.record_batch(
                        [pa.array(found, pa.binary()), pa.array([n] * len(found), pa.int64()), pa.array([item] * len(found), pa.string())],
                        ["window", "words", "item"],
                    )

    chosen = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "window binary, words long, item string").distinct()


def _automaton(windows: list[tuple[bytes, int, str | None]]) -> ahocorasick.Automaton:
    by_window: dict[bytes, tuple[int, set]] = {}
    for window, words, item in windows:
        by_window.setdefault(window, (words, set()))[1].add(item)
    automaton = ahocorasick.Automaton()
    for window, found in by_window.items():
        automaton.add_word(window.decode("latin-1"), found)  # a letter per byte
    automaton.make_automaton()
    return automaton


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places (in code points of ``text``) of runs of words ``[first, last)``."""
    raw = text.encode("utf-8")
    word = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    character = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(character[edge[2 * a]]), int(character[edge[2 * b - 1]])) for a, b in ranges]


def _scan(docs: DataFrame, key: tuple, windows, last: bool) -> DataFrame:
    """One reading of all texts; ``ranges`` and ``items`` found by earlier readings are taken along."""
    passed = [c for c in docs.columns if c not in ("ranges", "items")]
    types = {f.name: f.dataType for f in docs.schema.fields}
    kinds = T.StructType([T.StructField(c, types[c]) for c in passed if c != "text" or not last])
    kinds = kinds.add("n_words", "long").add("ranges", _RANGES_TYPE).add("items", T.ArrayType(T.StringType()))
    kinds = kinds.add("n_hit", "long").add("spans", _RANGES_TYPE) if last else kinds
    names = kinds.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others()
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = _automaton(windows.value)
        automaton = _AUTOMATA[key]
        for batch in batches:
            sizes, ranges, items, hits, spans = [], [], [], [], []
            old = batch.column("ranges").to_pylist() if "ranges" in batch.schema.names else [[]] * batch.num_rows
            held = batch.column("items").to_pylist() if "items" in batch.schema.names else [[]] * batch.num_rows
            for text, before, known in zip(batch.column("text"), old, held):
                text = text.as_py()
                words = words_of(text)
                read = (b" " + b" ".join(words) + b" ").decode("latin-1")
                found = [(r["first"], r["last"]) for r in before]
                names_of_items, gaps = set(known), None
                for end, (n, of_items) in automaton.iter(read) if len(automaton) and words else ():
                    if gaps is None:
                        gaps = np.flatnonzero(np.frombuffer(read.encode("latin-1"), np.uint8) == 32)
                    after = int(np.searchsorted(gaps, end))  # words before the closing gap
                    found.append((after - n, after))
                    names_of_items |= of_items
                found = _merged(found)
                sizes.append(len(words))
                ranges.append([{"first": a, "last": b} for a, b in found])
                items.append(sorted(i for i in names_of_items if i is not None))
                hits.append(sum(b - a for a, b in found))
                spans.append([{"first": a, "last": b} for a, b in _original_spans(text, found)] if found and last else [])
            made = {
                "n_words": pa.array(sizes, pa.int64()), "ranges": pa.array(ranges, _RANGES),
                "items": pa.array(items, pa.list_(pa.string())), "n_hit": pa.array(hits, pa.int64()), "spans": pa.array(spans, _RANGES),
            }
            columns = {n: batch.column(n) for n in passed} | made
            yield pa.record_batch([columns[n] for n in names], names)

    return docs.mapInArrow(run, kinds)


def find_passages(
    docs: DataFrame, items: DataFrame, size: int = 10, carry: bool = False, block_bytes: int = 8 << 20
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids as text, sorted), ``spans``, ``contaminated``.

    A window is ``size`` consecutive words of an item, or all words of a shorter one; words inside
    any occurrence are hit. ``spans`` are runs of hit words as places in the original text, in code
    points, end excluded. ``carry`` adds the whole row as ``row``.

    Nothing is shuffled but the distinct windows of the items. They reach the tasks by broadcast, at
    most ``block_bytes`` of them at a time: more windows are dealt into blocks by hash, each block has its
    automaton, and the texts are read once per block, findings being written between readings.

    Null and empty texts have no words; an item without words has no window; a repeated item counts
    once; windows of an item with a null id are hit, but the item is not listed. Repeated documents
    give repeated rows; an empty table gives none; without items nothing is hit.
    """
    spark = docs.sparkSession
    windows = stage(item_windows(items, "item_id", "text", size), "item-windows")
    total = windows.agg(F.sum(F.octet_length("window"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    state = texts_of(docs, carry=carry)
    for block in range(blocks):
        chosen = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block) if blocks > 1 else windows
        held = spark.sparkContext.broadcast([(bytes(r.window), r.words, r.item) for r in chosen.collect()])
        last = block == blocks - 1
        state = _scan(state if block == 0 else state.drop("n_words"), (spark.sparkContext.applicationId, held._jbroadcast.id()), held, last)
        if not last:
            state = stage(state, "passages-found")
    results = [F.col("doc_id"), F.col("n_words"), F.col("n_hit"), F.size("items").cast("long").alias("n_items"), F.col("items"), F.col("spans")]
    return state.select(*results, (F.col("n_hit") > 0).alias("contaminated"), *(["row"] if carry else []))
