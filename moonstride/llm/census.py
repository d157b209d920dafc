"""Counting keys over all texts, with the counts sent back to where the keys came from.

Texts stay in their place. Each task hashes its texts in blocks and sends a block's distinct keys,
sorted and cut by key range, as packed rows. Whoever gets a range adds up what all blocks said
of a key and answers every block with one value per key it asked for. The answers are written
under the shared folder by task; the next reading of the same texts finds them there. So a key
costs a few bytes on the way and its answer a bit or a byte, texts are never shuffled, and a key
that is everywhere comes at most once per block.

The scan must deal the same rows to the same tasks each time; ``fixed_scan`` sees to that, and
keys that do not fit their answers are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.llm.columns import pieces_of
from moonstride.llm.memories import forget_others, give_back
from moonstride.session import scratch_path, stage

BLOCK_BYTES = 6 << 20
# keys a range should hold, so that whoever answers holds a few times this many
KEYS_PER_RANGE = 1 << 20

_SENT = "range long, task long, block long, n long, keys binary, counts binary"
_ANSWERED = "task long, block long, range long, n long, check long, answers binary"


@dataclass
class Asked:
    """Distinct keys of a block, ascending; ``low`` are further 64 bits of the keys; ``counts`` weigh them."""

    keys: np.ndarray
    low: np.ndarray | None = None
    counts: np.ndarray | None = None  # of any fixed-width type, one row per key


Ask = Callable[[pa.RecordBatch, list], list[Asked]]
# (counts of each key, one row per sender; which key each row is; number of keys) -> answer per key, rows of statistics
Settle = Callable[[np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, dict]]


def fixed_scan(docs: DataFrame) -> DataFrame:
    """``docs`` if it only reads files or given rows, else a written copy of it."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return stage(docs, "texts") if any(x in plan for x in ("Exchange", "Sort", "Join", "Limit", "Sample", "InMemory")) else docs


def ranges_for(docs: DataFrame, keys_per_byte: float, keys: int = KEYS_PER_RANGE) -> int:
    """Number of key ranges, of about ``keys`` each, for so many keys per byte of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, int(size * keys_per_byte) // keys)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that those that are all alike take nothing once compressed."""
    width = values.dtype.itemsize
    return values.view(np.uint8).reshape(-1, width).T.tobytes()


def _from_planes(data: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    forget_others()
    n = 0
    for whole in batches:
        for batch in pieces_of(whole, BLOCK_BYTES):
            yield n, batch
            n += 1
        give_back()


def _sender(ask: Ask, ranges: int, earlier: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, replies = TaskContext.get().partitionId(), None
        for block, batch in blocks_of(batches):
            replies = replies or [Answers(path, task) for path in earlier]
            for group, asked in enumerate(ask(batch, [r.of(block) for r in replies])):
                bounds = np.arange(1, ranges, dtype=np.float64) * (2.0**64 / ranges)
                cuts = [0, *np.searchsorted(asked.keys, bounds.astype(np.uint64)).tolist(), len(asked.keys)]
                rows = [(r, a, b) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                for first in range(0, len(rows), 64):
                    some = rows[first : first + 64]
                    keys = [_planes(_steps(asked.keys[a:b])) + (b"" if asked.low is None else asked.low[a:b].tobytes()) for _, a, b in some]
                    counts = [b"" if asked.counts is None else _planes(asked.counts[a:b]) for _, a, b in some]
                    yield pa.record_batch(
                        [
                            pa.array([group * ranges + r for r, _, _ in some], pa.int64()), pa.array([task] * len(some), pa.int64()),
                            pa.array([block] * len(some), pa.int64()), pa.array([b - a for _, a, b in some], pa.int64()),
                            pa.array(keys, pa.binary()), pa.array(counts, pa.binary()),
                        ],
                        ["range", "task", "block", "n", "keys", "counts"],
                    )

    return run


def _settler(settle: Settle, kind: np.dtype | None, wide: bool):
    def answered(place: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        sizes = [r["n"] for r in rows]
        keys = np.concatenate([np.cumsum(_from_planes(r["keys"][: 8 * r["n"]], np.dtype(np.uint64)), dtype=np.uint64) for r in rows])
        if wide:
            low = np.concatenate([np.frombuffer(r["keys"], np.uint64, offset=8 * r["n"]) for r in rows])
            order = np.lexsort((low, keys))
            new = np.concatenate([[True], (np.diff(keys[order]) != 0) | (np.diff(low[order]) != 0)])
        else:
            order = np.argsort(keys, kind="stable")
            new = np.concatenate([[True], np.diff(keys[order]) != 0])
        of_row = np.empty(len(keys), np.int64)
        of_row[order] = np.cumsum(new) - 1
        first = np.zeros(len(keys), bool)
        first[order[new]] = True  # one sender per key
        counts = np.concatenate([_from_planes(r["counts"], kind) for r in rows]) if kind is not None else np.ones(len(keys), np.int64)
        answer, facts = settle(counts, of_row, first, int(new.sum()))
        ends = np.cumsum(sizes)
        for r, a, b in zip(rows, ends - sizes, ends):
            part = answer[a:b]
            packed = np.packbits(part).tobytes() if part.dtype == bool else _planes(part)
            yield pa.record_batch([[r["task"]], [r["block"]], [place], [r["n"]], pa.array([int(keys[b - 1].view(np.int64))]), pa.array([packed], pa.binary())], ["task", "block", "range", "n", "check", "answers"])
        for name, value in facts.items():
            yield pa.record_batch([[-1], [name], [place], [0], pa.array([0]), pa.array([np.asarray(value, np.float64).tobytes()], pa.binary())], ["task", "block", "range", "n", "check", "answers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["range"] != place and rows:
                    yield from answered(place, rows)
                    rows = []
                    give_back()
                place = row["range"]
                rows.append(row)
        if rows:
            yield from answered(place, rows)
        give_back()

    return run


def census(
    docs: DataFrame, ask: Ask, settle: Settle, ranges: int, kind: np.dtype | None = None, wide: bool = False, earlier: list[str] = []
) -> str:
    """Ask for keys of all blocks, settle them, and return the folder of answers.

    ``ask(batch, answers)`` gets a block and, per folder in ``earlier``, its answers. ``settle(counts,
    key_of, first, n)`` gets all rows of a range, which of the ``n`` keys each is, and whether it is
    the one row of its key that is marked as first; it returns an answer per row (booleans are
    packed into bits) and named statistics, which ``facts_of`` reads.
    """
    sent = docs.mapInArrow(_sender(ask, ranges, earlier), _SENT)
    settled = sent.repartition("range").sortWithinPartitions("range", "task", "block").mapInArrow(_settler(settle, kind, wide), _ANSWERED)
    path = scratch_path(docs.sparkSession, "answers")
    settled.repartition("task", F.when(F.col("task") < 0, F.col("range"))).sortWithinPartitions("task", "block", "range").write.partitionBy("task").parquet(path)
    return path


def facts_of(docs: DataFrame, path: str) -> DataFrame:
    """Statistics of a census: ``fact`` (its number) and ``value`` (float64 bytes), one row per range."""
    spark = docs.sparkSession
    stored = spark.read.schema(_ANSWERED).parquet(path)
    return stored.where("task = -1").select(F.col("block").alias("fact"), F.col("answers").alias("value"))


def sums_of(docs: DataFrame, path: str) -> dict[int, np.ndarray]:
    """Statistics added up over all ranges; each must be a short vector of one length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fact, value in zip(batch.column("fact").to_pylist(), batch.column("value").to_pylist()):
                held = np.frombuffer(value)
                yield pa.record_batch([pa.array([fact] * len(held), pa.int64()), pa.array(range(len(held)), pa.int64()), pa.array(held)], ["fact", "place", "value"])

    rows = facts_of(docs, path).mapInArrow(add, "fact long, place long, value double").groupBy("fact", "place").agg(F.sum("value").alias("value")).orderBy("fact", "place").collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r.fact, []).append(r.value)
    return {k: np.array(v) for k, v in out.items()}


class Answers:
    """What a task's blocks were answered, read block by block in the order in which they were sent."""

    def __init__(self, path: str, task: int) -> None:
        store, place = fs.FileSystem.from_uri(path)
        folder = f"{place}/task={task}"
        found = store.get_file_info(folder).type != fs.FileType.NotFound
        listed = store.get_file_info(fs.FileSelector(folder)) if found else []
        self.files = [self._rows(store, f.path) for f in listed if f.path.endswith(".parquet")]
        self.ahead = [next(rows, None) for rows in self.files]

    @staticmethod
    def _rows(store: fs.FileSystem, path: str) -> Iterator[tuple]:
        """(block, range, n, check, answers) of a file, which holds them by block; a few rows are held at a time."""
        with store.open_input_file(path) as source:
            file = pq.ParquetFile(source, pre_buffer=False, buffer_size=1 << 20)
            for batch in file.iter_batches(batch_size=16, columns=["block", "range", "n", "check", "answers"]):
                yield from zip(*(batch.column(c).to_pylist() for c in ("block", "range", "n", "check", "answers")))

    def of(self, block: int) -> BlockAnswers:
        """The answers of ``block``; blocks are asked for in ascending order."""
        mine = []
        for place, rows in enumerate(self.files):
            row = self.ahead[place]
            while row is not None and row[0] <= block:
                if row[0] == block:
                    mine.append(row[1:])
                row = next(rows, None)
            self.ahead[place] = row
        return BlockAnswers(sorted(mine))


@dataclass
class BlockAnswers:
    rows: list

    def read(self, asked: list[Asked], ranges: int, kind: np.dtype | type) -> list[np.ndarray]:
        """One array per ``asked``, in the order of its keys."""
        out = []
        for group, keys in enumerate(asked):
            rows = [r for r in self.rows if r[0] // ranges == group]
            ends = np.cumsum([r[1] for r in rows], dtype=np.int64)
            if (ends[-1] if len(ends) else 0) != len(keys.keys) or any(int(keys.keys[e - 1].view(np.int64)) != r[2] for e, r in zip(ends, rows)):
                raise RuntimeError("the scan dealt other rows to this task than before")
            if kind is bool:
                parts = [np.unpackbits(np.frombuffer(r[3], np.uint8), count=r[1]).astype(bool) for r in rows]
            else:
                parts = [_from_planes(r[3], np.dtype(kind)) for r in rows]
            out.append(np.concatenate(parts) if parts else np.zeros(0, kind))
        return out
