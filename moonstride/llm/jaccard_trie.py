"""Joining texts whose sets of five-word runs have a Jaccard similarity of 0.8 or more, by prefix trees.

All sets are kept in one global order, rare runs first. Two similar sets share one of their first
runs, so sets meet in the group of the smallest document that has such a run; a set comes to a
group once, however many runs lead there. A group's sets form a trie. Each set walks it with the
overlap so far, which all sets below a node share, and leaves a subtree when the overlap can no
longer suffice: by the runs left on either side and the sizes below. Subtrees already linked with
the set are passed over, so a group of many near copies costs about one comparison per set.

Before that, sets without enough runs in common with any other are told apart by a census of a few
runs per set, and equal sets are taken together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.llm.census import KEYS_PER_RANGE, Answers, Asked, blocks_of, census, fixed_scan, ranges_for
from moonstride.llm.columns import pieces_of, texts_of, utf8
from moonstride.llm.components import connected_components
from moonstride.llm.word_hashes import mix, run_hashes, words_of
from moonstride.session import stage

SIZE = 5
PERCENT = 80
# runs in a trie; larger groups are cut into parts that are joined pair by pair
TRIE_RUNS = 1 << 20
_CHUNK = 64

_MIN_AND_COUNT = np.dtype([("least", "<i8"), ("n", "<i8")])


def _ceil(a, b):
    return -(-a // b)


def least_overlap(sizes):
    """Runs that a set of this size shares with any similar one, at least."""
    return _ceil(PERCENT * sizes, 100)


class Sets:
    """Distinct runs of every text, ascending by hash: ``runs[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        runs, sizes = [], []
        for piece in pieces_of(batch, 2 << 20):
            words = words_of(*utf8(piece.column("text")))
            hashes, texts, counts = words.hashes(lower=True), words.text_of, np.diff(words.bounds)
            n = max(0, len(texts) - SIZE + 1)
            valid = np.flatnonzero(texts[:n] == texts[SIZE - 1 :]) if n else np.zeros(0, np.int64)
            found, of_text = [run_hashes(hashes, SIZE)[valid]], [texts[valid]]
            for short in range(1, SIZE):
                rows = np.flatnonzero(counts == short)
                if len(rows):
                    found.append(mix(run_hashes(hashes, short)[words.bounds[rows]] + np.uint64(short)))
                    of_text.append(rows)
            found, of_text = np.concatenate(found), np.concatenate(of_text)
            order = np.lexsort((found, of_text))
            found, of_text = found[order], of_text[order]
            new = np.concatenate([[True], (np.diff(found) != 0) | (np.diff(of_text) != 0)])[: len(found)]
            runs.append(found[new])
            sizes.append(np.bincount(of_text[new], minlength=len(counts)))
        self.runs, self.sizes = np.concatenate(runs), np.concatenate(sizes)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        # two similar sets share at least `needed` of the first `looked_at` runs of either
        self.needed = _ceil(self.sizes, 20)
        self.looked_at = self.sizes - least_overlap(self.sizes) + self.needed

    def first_runs(self) -> tuple[np.ndarray, np.ndarray]:
        place = np.arange(len(self.runs)) - np.repeat(self.bounds[:-1], self.sizes)
        chosen = place < np.repeat(self.looked_at, self.sizes)
        return self.runs[chosen], np.repeat(np.arange(len(self.sizes)), self.looked_at)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True, return_counts=True)


def _held_twice(counts: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    return (np.bincount(key_of, weights=counts, minlength=n) >= 2)[key_of], {}


def _total(counts: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    return np.bincount(key_of, weights=counts, minlength=n).astype(np.int64)[key_of], {}


def _least(values: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, key_of, values["least"])
    alone = np.bincount(key_of, weights=values["n"], minlength=n) < 2
    return np.where(alone, -1, 0)[key_of] + np.where(alone[key_of], 0, least[key_of]), {}


def set_table(docs: DataFrame) -> DataFrame:
    """Staged: ``doc_id``, ``n`` and, where enough runs are shared, the set as ``text`` (64-bit hashes) with its digest."""
    base = fixed_scan(texts_of(docs))
    ranges = ranges_for(base, 1 / 20)

    def asked(sets: Sets) -> tuple[Asked, np.ndarray, np.ndarray]:
        runs, of_text = sets.first_runs()
        keys, place, counts = _distinct(runs)
        return Asked(keys, counts=np.minimum(counts, 2).astype(np.uint8)), place, of_text

    shared = census(base, lambda batch, _: [asked(Sets(batch))[0]], _held_twice, ranges, np.dtype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies = None
        for block, batch in blocks_of(batches):
            replies = replies or Answers(shared, TaskContext.get().partitionId())
            sets = Sets(batch)
            keys, place, of_text = asked(sets)
            twice = replies.of(block).read([keys], ranges, bool)[0][place]
            enough = (np.bincount(of_text[twice], minlength=len(sets.sizes)) >= sets.needed) & (sets.sizes > 0)
            ids = batch.column("doc_id")
            for first in range(0, len(sets.sizes), 256):
                rows = range(first, min(first + 256, len(sets.sizes)))
                runs = [sets.runs[sets.bounds[i] : sets.bounds[i + 1]] if enough[i] else None for i in rows]
                with np.errstate(over="ignore"):
                    sums = [None if r is None else int(mix(r + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) for r in runs]
                    more = [None if r is None else int(mix(r ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64)) for r in runs]
                yield pa.record_batch(
                    [
                        ids.slice(first, len(rows)), pa.array(sets.sizes[first : first + 256], pa.int64()),
                        pa.array([None if r is None else r.tobytes() for r in runs], pa.binary()),
                        pa.array(sums, pa.int64()), pa.array(more, pa.int64()),
                    ],
                    ["doc_id", "n", "text", "digest", "digest_2"],
                )

    return stage(base.mapInArrow(run, "doc_id long, n long, text binary, digest long, digest_2 long"), "sets")


class Classes:
    """The different sets of a block: a 128-bit key and the first row of each."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        digest, more, n = (batch.column(c).to_numpy().view(np.uint64) for c in ("digest", "digest_2", "n"))
        low = more ^ mix(n)
        order = np.lexsort((low, digest))
        digest, low = digest[order], low[order]
        new = np.concatenate([[True], (np.diff(digest) != 0) | (np.diff(low) != 0)])[: len(order)]
        self.keys, self.low, self.rows = digest[new], low[new], order[new]

    def asked(self) -> Asked:
        return Asked(self.keys, low=self.low)


def _one_sender(counts: np.ndarray, key_of: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, dict]:
    return first, {}


def one_of_each(rows: DataFrame) -> DataFrame:
    """Staged: ``doc_id``, ``n`` and ``text`` of one row per different set; sets stay where they are, only digests move."""
    ranges = max(8, rows.count() // KEYS_PER_RANGE)
    senders = census(rows, lambda batch, _: [Classes(batch).asked()], _one_sender, ranges, wide=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies = None
        for block, batch in blocks_of(batches):
            replies = replies or Answers(senders, TaskContext.get().partitionId())
            classes = Classes(batch)
            kept = replies.of(block).read([classes.asked()], ranges, bool)[0]
            yield batch.take(pa.array(np.sort(classes.rows[kept]))).select(["doc_id", "n", "text"])

    return stage(rows.mapInArrow(run, "doc_id long, n long, text binary"), "distinct-sets")


class Ordered:
    """Sets of a block in global order, with the groups each set goes to."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        data, offsets = utf8(batch.column("text"))
        self.ids, self.n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
        self.runs = np.frombuffer(data.tobytes(), np.uint64)
        self.of_set = np.repeat(np.arange(len(self.n)), np.diff(offsets) // 8)

    def ask_runs(self) -> Asked:
        keys, self.place, counts = _distinct(self.runs)
        return Asked(keys, counts=counts.astype(np.int64))

    def order(self, holders: np.ndarray) -> None:
        """Rare runs first; runs of one set alone are only counted (they come before all others)."""
        held = holders[self.place]
        shared = held > 1
        level = np.floor(np.log2(np.maximum(held[shared], 1))).astype(np.uint64)
        keys, of_set = (level << np.uint64(58)) | (self.runs[shared] >> np.uint64(6)), self.of_set[shared]
        order = np.lexsort((keys, of_set))
        self.keys, self.of_set = keys[order], of_set[order]
        self.sizes = np.bincount(self.of_set, minlength=len(self.n))
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        prefix = np.maximum(0, self.n - least_overlap(self.n) + 1 - (self.n - self.sizes))
        place = np.arange(len(self.keys)) - self.bounds[self.of_set]
        chosen = place < prefix[self.of_set]
        self.prefix_runs, self.prefix_sets = self.keys[chosen], self.of_set[chosen]

    def ask_groups(self) -> Asked:
        keys, self.place, counts = _distinct(mix(self.prefix_runs))
        values = np.zeros(len(keys), _MIN_AND_COUNT)
        values["least"], values["n"] = np.iinfo(np.int64).max, counts
        np.minimum.at(values["least"], self.place, self.ids[self.prefix_sets])
        return Asked(keys, counts=values)

    def meet(self, groups: np.ndarray) -> None:
        found = groups[self.place]
        meets = found != -1
        pairs = np.unique(np.stack([self.prefix_sets[meets], found[meets]], axis=1), axis=0)
        self.member, self.group = pairs[:, 0], pairs[:, 1]

    def ask_sizes(self) -> Asked:
        keys, self.place = np.unique(mix(self.group.view(np.uint64)), return_inverse=True)
        return Asked(keys, counts=np.bincount(self.place, weights=self.sizes[self.member], minlength=len(keys)).astype(np.int64))


def trie_links(ids: list[int], sizes: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join what is similar, directly or through others: at most one fewer than sets.

    ``sets`` are ascending runs that another set has as well; ``sizes`` count all runs.
    """
    order = sorted(range(len(ids)), key=lambda i: sets[i].astype(">u8").tobytes())
    ids, sizes, sets = [ids[i] for i in order], sizes[order], [sets[i] for i in order]
    count, lengths = len(ids), np.array([len(s) for s in sets])
    same = np.zeros(count, np.int64)  # runs shared with the set before
    for i in range(1, count):
        n = min(lengths[i], lengths[i - 1])
        apart = np.flatnonzero(sets[i][:n] != sets[i - 1][:n])
        same[i] = apart[0] if len(apart) else n

    def node(low: int, high: int, depth: int):
        end = int(same[low + 1 : high].min()) if high - low > 1 else int(lengths[low])
        part = sizes[low:high]
        return low, high, depth, end, int(part.min()), int(part.max()), int(lengths[low:high].max()) - end, []

    root = node(0, count, 0)
    waiting = [root]
    while waiting:
        low, high, _, end, *_, below = waiting.pop()
        if high - low > 1:
            cuts = [low, *(low + 1 + np.flatnonzero(same[low + 1 : high] == end)).tolist(), high]
            below += [node(a, b, end) for a, b in zip(cuts, cuts[1:])]
            waiting += below
    part_of, links = np.arange(count), []
    for i in range(count - 1):
        mine, size = sets[i], int(sizes[i])
        walk = [(root, 0)]
        while walk:
            (low, high, start, end, smallest, largest, longest, below), overlap = walk.pop()
            if high <= i + 1 or 100 * smallest * PERCENT > 10000 * size or 100 * largest < PERCENT * size:
                continue
            if (part_of[max(low, i + 1) : high] == part_of[i]).all():
                continue
            needed = _ceil(PERCENT * (size + max(smallest, _ceil(PERCENT * size, 100))), 100 + PERCENT)
            path, alive = sets[low], True
            for first in range(start, end, _CHUNK):
                runs = path[first : min(first + _CHUNK, end)]
                at = np.searchsorted(mine, runs)
                overlap += int((mine[np.minimum(at, len(mine) - 1)] == runs).sum()) if len(mine) else 0
                left = len(mine) - int(np.searchsorted(mine, runs[-1], side="right"))
                if overlap + min(left, end - first - len(runs) + longest) < needed:
                    alive = False
                    break
            if not alive:
                continue
            if below:
                walk += [(child, overlap) for child in reversed(below)]
            else:  # one set
                if 100 * overlap >= PERCENT * (size + int(sizes[low]) - overlap) and part_of[low] != part_of[i]:
                    links.append((ids[i], ids[low]))
                    a, b = part_of[i], part_of[low]
                    part_of[part_of == b] = a
    return links


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links(rows: list[dict]) -> pa.RecordBatch:
        found = trie_links([r["doc_id"] for r in rows], np.array([r["n"] for r in rows]), [np.frombuffer(r["runs"], np.uint64) for r in rows])
        return pa.record_batch([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            here = (row["group"], row["part"], row["other"])
            if here != at and rows:
                yield links(rows)
                rows = []
            at = here
            rows.append(row)
    if rows:
        yield links(rows)


def similar_pairs(sets: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` (ids) that join all similar sets of ``sets`` (``doc_id``, ``n``, ``text``: runs)."""
    total = sets.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(8, total // 8 // (1 << 20))
    whole = np.dtype(np.int64)

    def ask_runs(batch: pa.RecordBatch, _: list) -> list[Asked]:
        return [Ordered(batch).ask_runs()]

    def ordered(batch: pa.RecordBatch, replies: list) -> Ordered:
        out = Ordered(batch)
        out.order(replies[0].read([out.ask_runs()], ranges, whole)[0])
        return out

    def ask_groups(batch: pa.RecordBatch, replies: list) -> list[Asked]:
        return [ordered(batch, replies).ask_groups()]

    def met(batch: pa.RecordBatch, replies: list) -> Ordered:
        out = ordered(batch, replies)
        out.meet(replies[1].read([out.ask_groups()], ranges, whole)[0])
        return out

    def ask_sizes(batch: pa.RecordBatch, replies: list) -> list[Asked]:
        return [met(batch, replies).ask_sizes()]

    holders = census(sets, ask_runs, _total, ranges, whole)
    groups = census(sets, ask_groups, _least, ranges, _MIN_AND_COUNT, earlier=[holders])
    sizes = census(sets, ask_sizes, _total, ranges, whole, earlier=[holders, groups])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies = None
        for block, batch in blocks_of(batches):
            task = TaskContext.get().partitionId()
            replies = replies or [Answers(path, task) for path in (holders, groups, sizes)]
            told = [r.of(block) for r in replies]
            out = met(batch, told)
            parts = _ceil(told[2].read([out.ask_sizes()], ranges, whole)[0][out.place], TRIE_RUNS)
            own = (mix(out.ids.astype(np.int64).view(np.uint64))[out.member] % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
            rows: list[tuple] = []
            for member, group, count, part in zip(out.member.tolist(), out.group.tolist(), parts.tolist(), own.tolist()):
                runs = out.keys[out.bounds[member] : out.bounds[member + 1]].tobytes()
                for other in range(count):
                    rows.append((group, min(part, other), max(part, other), int(out.ids[member]), int(out.n[member]), runs))
                    if len(rows) == 256:
                        yield _rows(rows)
                        rows = []
            if rows:
                yield _rows(rows)

    met_rows = sets.mapInArrow(run, "group long, part long, other long, doc_id long, n long, runs binary")
    together = met_rows.repartition("group", "part", "other").sortWithinPartitions("group", "part", "other")
    return together.mapInArrow(_joined, "a long, b long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["group", "part", "other", "doc_id", "n", "runs"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` (size of its set) and ``component_id`` (smallest id linked with it, through others too).

    A set holds the distinct runs of five words (A-Z in lower case; parted by blanks and the controls 9 to
    13); a text of fewer words is one run. Two documents link when 100 times the common runs are at
    least 80 times the runs of both together. Every link between different sets counts; no group is cut.

    Null and empty texts have an empty set and link with nothing. A row with a null id links with nothing
    and has a null component. Rows with the same id are one document: they share a component.
    An empty table gives no rows; other columns are not read.
    """
    table = set_table(docs)
    key = ["digest", "digest_2", "n"]
    rows = table.where("text IS NOT NULL AND doc_id IS NOT NULL")
    classes = rows.groupBy(*key).agg(F.min("doc_id").alias("least"))
    slim = rows.select("doc_id", *key).join(classes, key)
    distinct = one_of_each(rows)
    links = stage(similar_pairs(distinct), "links")
    copies = slim.where("doc_id <> least").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    components = connected_components(links.union(copies))
    found = table.select("doc_id", F.col("n").alias("n_shingles")).join(components, F.col("doc_id") == F.col("node"), "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
