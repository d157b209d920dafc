"""Centroid clustering of integer vectors by a tournament over bisectors.

For every pair of centroids a < b the hyperplane half-way between them is precomputed as an integer
normal 2 (b - a) and a threshold |b|^2 - |a|^2. A vector meets the centroids one after another: the sign
of normal * x - threshold drops one of two, zero the one with the larger number. After k - 1 signs the
nearest is left, and only its distance is worked out. All numbers are exact: products stay in doubles
or 64-bit integers where their bound proves that nothing is rounded, else Python's integers are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.session import stage

LIMB = 32  # bits; sums travel as parts of this size, so that adding them up never overflows
_EXACT_DOUBLE, _EXACT_LONG = 1 << 53, 1 << 62


def integer_vectors(vectors: DataFrame, size: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``hash`` and ``numbers`` (doubles, all whole) of vectors with exactly ``size`` finite components.

    A component x becomes floor(scale * x) as doubles compute it; a floor is always exact as a double. Vectors
    that are null, of another size, or with a component that is null, not finite or too large to be scaled go.
    """
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    found = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("numbers"))
    finite = F.forall("numbers", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    found = found.where((F.size("numbers") == size) & finite)
    # Spark's own floor gives a 64-bit integer, so larger numbers, whole already, are left as they are
    whole = F.transform("numbers", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    return found.select("vec_id", whole.alias("numbers"))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("numbers").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        small = np.abs(values).max(axis=1, initial=0) < 2**31
        rows = [(v.astype("<i4") if s else v.astype("<f8")).tobytes() for v, s in zip(values, small.tolist())]
        yield pa.record_batch([batch.column("vec_id"), pa.array(rows, pa.binary())], ["vec_id", "packed"])


def _whole(values: np.ndarray) -> np.ndarray:
    """Python integers of whole doubles."""
    return np.array([int(v) for v in values.ravel().tolist()], object).reshape(values.shape)


def _unpacked(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows in the batch, and their numbers."""
    rows = batch.column("packed")
    wide = np.array([len(r.as_buffer()) != 4 * size for r in rows], bool)
    for kind, chosen in (("<i4", np.flatnonzero(~wide)), ("<f8", np.flatnonzero(wide))):
        if len(chosen):
            data = b"".join(rows[int(i)].as_py() for i in chosen) if wide.any() else b"".join(rows.to_pylist())
            values = np.frombuffer(data, kind).reshape(-1, size)
            yield chosen, values.astype(np.int64) if kind == "<i4" else _whole(values)


class Tournament:
    """Normals and thresholds of all pairs of ``centroids`` (lists of integers)."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.centroids = centroids
        self.k, self.size = len(centroids), len(centroids[0]) if centroids else 0
        self.largest = max((abs(v) for c in centroids for v in c), default=0)
        self.normals, self.thresholds = {}, {}
        for b in range(self.k):
            for a in range(b):
                self.normals[a, b] = [2 * (y - x) for x, y in zip(centroids[a], centroids[b])]
                self.thresholds[a, b] = sum(y * y - x * x for x, y in zip(centroids[a], centroids[b]))

    def kind_for(self, largest: int):
        """The number type in which signs and distances of vectors up to ``largest`` are exact."""
        reach = 4 * self.size * (largest + self.largest + 1) ** 2
        return np.float64 if reach < _EXACT_DOUBLE else np.int64 if reach < _EXACT_LONG else object

    def assign(self, values: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The nearest centroid of each row (the smaller number of equally near ones) and the squared distance."""
        largest = int(max(abs(values.max(initial=0)), abs(values.min(initial=0))))
        kind = self.kind_for(largest)
        x = values.astype(kind)
        best = np.zeros(len(x), np.int64)
        for b in range(1, self.k):
            won = np.zeros(len(x), bool)
            for a in np.unique(best).tolist():
                rows = np.flatnonzero(best == a)
                signs = x[rows] @ np.array(self.normals[a, b], kind) - kind(self.thresholds[a, b]) if kind is not object else (
                    x[rows] @ np.array(self.normals[a, b], object) - self.thresholds[a, b])
                won[rows] = signs > 0
            best[won] = b
        apart = x - np.array(self.centroids, kind)[best]
        return best, [int(d) for d in (apart * apart).sum(axis=1).tolist()]


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, part) with value = sum of part << LIMB * place; the last part carries the sign."""
    place = 0
    while True:
        part, value = value & ((1 << LIMB) - 1), value >> LIMB
        if value in (0, -1):
            yield place, part + (value << LIMB)
            return
        yield place, part
        place += 1


def _sums(vectors: DataFrame, size: int, centroids: list[list[int]]) -> dict[int, list[int]]:
    """Per cluster that has vectors: the sums of their components, their distances' sum, their number.

    Tasks add up what they hold; a row per cluster, component and limb of each task is added up by Spark, and
    clusters * (components + 2) exact sums come to the driver.
    """
    model = Tournament(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, values in _unpacked(batch, size):
                best, apart = model.assign(values)
                far = np.array(apart, object)
                for c in np.unique(best).tolist():
                    mine = best == c
                    # a batch has fewer than 2^31 rows of 32-bit numbers, so their sums fit in 64 bits
                    sums = [*values[mine].sum(axis=0).tolist(), sum(far[mine].tolist()), int(mine.sum())]
                    for d, value in enumerate(sums):
                        totals[c, d] = totals.get((c, d), 0) + int(value)
        rows = [(c, d, place, part) for (c, d), value in totals.items() for place, part in _limbs(value)]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "place", "limb", "part"])

    parts = vectors.mapInArrow(run, "cluster int, place int, limb int, part long")
    out: dict[int, list[int]] = {}
    for row in parts.groupBy("cluster", "place", "limb").agg(F.sum("part").alias("part")).collect():
        sums = out.setdefault(row.cluster, [0] * (size + 2))
        sums[row.place] += row.part << LIMB * row.limb
    return out


def cluster(
    vectors: DataFrame, k: int = 8, size: int = 64, scale: int = 1024, rounds: int = 10, seed: str = "3",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Per kept vector: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``,
    ``centroid`` (array of decimal integers as text) and ``centroid_sha256``.

    Vectors become whole numbers and are kept as ``integer_vectors`` says. The first centroids are the ``k``
    kept vectors with the smallest sha256 of ``seed:vec_id``, in that order; of equal ids the one with the
    smaller numbers comes first, null ids come last. In each round every vector goes to the nearest centroid
    and centroids with vectors move to their floored mean; then vectors are assigned once more. With fewer
    than ``k`` vectors there are as many centroids; no vector gives no row. Repeated rows count as often as
    they are there and null ids are handed on. Distances and sums beyond a long are null. Other columns are
    not read. The kept vectors are written once, packed; every round reads them without a shuffle of rows.
    """
    whole = integer_vectors(vectors, size, scale, id_col, vector_col)
    staged = stage(whole.mapInArrow(lambda batches: _packed(batches, size), "vec_id long, packed binary"), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = whole.orderBy(order.asc_nulls_last(), "numbers").limit(k).collect()
    centroids = [[int(v) for v in row.numbers] for row in first]
    for _ in range(rounds if centroids else 0):
        for c, sums in _sums(staged, size, centroids).items():
            centroids[c] = [s // sums[-1] for s in sums[:size]]
    last = _sums(staged, size, centroids) if centroids else {}
    model = Tournament(centroids)
    in_long = lambda n: n if n < 1 << 63 else None
    spread = [in_long(last[c][size]) if c in last else 0 for c in range(len(centroids))]
    total = in_long(sum(sums[size] for sums in last.values()))
    names = [[str(v) for v in c] for c in centroids]
    digests = [hashlib.sha256(",".join(c).encode()).hexdigest() for c in names]
    schema = pa.schema([
        ("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("cluster_inertia", pa.int64()),
        ("inertia", pa.int64()), ("centroid", pa.list_(pa.string())), ("centroid_sha256", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, values in _unpacked(batch, size):
                best, apart = model.assign(values)
                mine = best.tolist()
                columns = [
                    batch.column("vec_id").take(pa.array(places)), mine, [in_long(d) for d in apart],
                    [spread[c] for c in mine], [total] * len(mine), [names[c] for c in mine], [digests[c] for c in mine],
                ]
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

    kinds = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<string>, centroid_sha256 string"
    return staged.mapInArrow(run, kinds)
