"""Removing repeated passages: every word in a window that starts at another place too.

A count-min sketch goes first. Its cells are counted by key range over all blocks (the sum of the
blocks' own sketches), and each block learns which of its cells were counted twice or more; a
window is estimated repeated if all its cells were. Estimates are never too low, so no repeat is
lost. Only those windows are then grouped exactly, by 128-bit hash. Window counts of one block
are added up before they are sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.llm.census import Answers, Asked, blocks_of, census, fixed_scan, ranges_for
from moonstride.llm.columns import pieces_of, texts_of, utf8
from moonstride.llm.word_hashes import Words, mix, run_hashes, words_of

_DEPTH = 2
_SALT = [np.uint64(0), np.uint64(0xA0761D6478BD642F)]


class Windows:
    """All windows of a block: their texts' words, and two hashes for each start (valid ones only)."""

    def __init__(self, batch: pa.RecordBatch, size: int, second: bool) -> None:
        high, low, starts, self.words, at = [], [], [], [], 0
        for piece in pieces_of(batch, 2 << 20):
            words = words_of(*utf8(piece.column("text")))
            self.words.append(words)
            texts = words.text_of
            n = max(0, len(texts) - size + 1)
            valid = np.flatnonzero(texts[:n] == texts[size - 1 :]) if n else np.zeros(0, np.int64)
            high.append(run_hashes(words.hashes(), size)[valid])
            if second:
                low.append(run_hashes(words.hashes(second=True), size, second=True)[valid])
            starts.append(valid + at)
            at += len(texts)
        self.high, self.starts = np.concatenate(high), np.concatenate(starts)
        self.low = np.concatenate(low) if second else None


def _cells(windows: Windows, bits: int) -> list[tuple[Asked, np.ndarray]]:
    """Per row of the sketch: distinct cells with counts (2 stands for more), and the cell of each window."""
    out, drop = [], np.uint64(64 - bits)
    for salt in _SALT[:_DEPTH]:
        cells = (mix(windows.high ^ salt) >> drop) << drop
        keys, place, counts = np.unique(cells, return_inverse=True, return_counts=True)
        out.append((Asked(keys, counts=np.minimum(counts, 2).astype(np.uint8)), place))
    return out


def _candidates(windows: Windows, estimated: np.ndarray) -> tuple[Asked, np.ndarray]:
    """Distinct windows among those estimated repeated, with counts, and which of them each is."""
    high, low = windows.high[estimated], windows.low[estimated]
    order = np.lexsort((low, high))
    new = np.concatenate([[True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)])[: len(order)]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    counts = np.bincount(place, minlength=int(new.sum()))
    return Asked(high[order[new]], low[order[new]], np.minimum(counts, 2).astype(np.uint8)), place


def _repeated(counts: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    return (np.bincount(key_of, weights=counts, minlength=n) >= 2)[key_of], {}


def remove_repeats(docs: DataFrame, size: int = 35, cells_per_window: int = 8, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept`` (text).

    Words are parted by blanks and the controls 9 to 13 and otherwise unchanged. A word goes if a
    window of ``size`` words covers it whose words also start anywhere else, in any row, the same
    included; all windows are judged on the input. Kept words are joined by one blank.

    Null and empty texts have no words; a text of fewer than ``size`` words keeps all; a row that
    repeats another loses all its words if it has ``size`` of them; ids are only handed on, null or
    repeated as they are; an empty table gives no rows.

    The sketch has two rows of at least ``cells_per_window`` cells per possible window, so its width
    grows with the input and nothing of it is broadcast.
    """
    base = fixed_scan(texts_of(docs))
    ranges = ranges_for(base, 1 / 6)
    possible = max(1, base.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 4
    bits = min(62, max(16, int(np.ceil(np.log2(max(2, possible * cells_per_window))))))

    def estimated(windows: Windows, replies) -> np.ndarray:
        cells = _cells(windows, bits)
        twice = replies.read([asked for asked, _ in cells], ranges, bool)
        return np.logical_and.reduce([t[place] for t, (_, place) in zip(twice, cells)])

    def ask_cells(batch: pa.RecordBatch, _: list) -> list[Asked]:
        return [asked for asked, _ in _cells(Windows(batch, size, second=False), bits)]

    def ask_windows(batch: pa.RecordBatch, replies: list) -> list[Asked]:
        windows = Windows(batch, size, second=True)
        return [_candidates(windows, estimated(windows, replies[0]))[0]]

    small = np.dtype(np.uint8)
    sketch = census(base, ask_cells, _repeated, ranges, small)
    exact = census(base, ask_windows, _repeated, ranges, small, wide=True, earlier=[sketch])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, replies = TaskContext.get().partitionId(), None
        for block, batch in blocks_of(batches):
            replies = replies or (Answers(sketch, task), Answers(exact, task))
            windows = Windows(batch, size, second=True)
            chosen = np.flatnonzero(estimated(windows, replies[0].of(block)))
            asked, place = _candidates(windows, chosen)
            twice = replies[1].of(block).read([asked], ranges, bool)[0]
            starts = windows.starts[chosen[twice[place]]]
            total = sum(len(w.starts) for w in windows.words)
            edges = np.zeros(total + 1, np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + size, -1)
            gone = np.cumsum(edges)[:-1] > 0
            ids, at, rows = batch.column("doc_id"), 0, 0
            for words in windows.words:
                n = len(words.bounds) - 1
                yield _kept(ids.slice(rows, n), words, gone[at : at + len(words.starts)], with_text)
                at, rows = at + len(words.starts), rows + n

    return base.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def _kept(ids: pa.Array, words: Words, gone: np.ndarray, with_text: bool) -> pa.RecordBatch:
    data, hashes, texts, removed = words.data.tobytes(), [], [], []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        stay = np.flatnonzero(~gone[a:b]) + a
        text = b" ".join([data[s:e] for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist())])
        hashes.append(hashlib.sha256(text).hexdigest())
        removed.append(b - a - len(stay))
        if with_text:
            texts.append(text.decode())
    columns = [ids, pa.array(np.diff(words.bounds), pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return pa.record_batch(columns + [pa.array(texts, pa.string())] * with_text, names + ["kept"] * with_text)
