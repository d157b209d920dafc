"""Removing lines that many documents share, with levelled sorted runs of line hashes.

Documents come in batches, highest ids first. What a batch knows of its lines (hash, documents,
highest document) is merge-anti-joined with the runs so far: a line that a run already holds in
enough documents is settled, its highest document known, and adds nothing. The rest becomes a new run,
bucketed and sorted by hash. When a level has ``fanout`` runs they are merged into one of the next
level. All of it is DataFrame functions; a run is read by bucket and never shuffled again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moonstride.llm.columns import whole_row
from moonstride.session import scratch_path, stage

_KEY = ["h1", "h2"]
_RUN = "h1 long, h2 long, docs long, last long"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """Blanks and the controls 9 to 13 stripped at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(_BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


class LineRuns:
    """Runs of (``h1``, ``h2``, ``docs``, ``last``): in how many documents, and the highest of them."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _store(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths[name] = scratch_path(self.spark, "line-run")
        run.write.format("parquet").bucketBy(buckets, *_KEY).sortBy(*_KEY).option("path", self.paths[name]).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._store(self._merged(old), level + 1)
            for table in old:
                self.spark.sql(f"DROP TABLE {table}")

    def _merged(self, tables: list[str]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed scans as dealt by key, which it is not
        rows = reduce(DataFrame.union, (self.spark.read.schema(_RUN).parquet(self.paths[t]) for t in tables))
        return rows.groupBy(*_KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (``h1``, ``h2``, ``doc_id``); its ids must be below those of all batches before."""
        batch = lines.distinct().groupBy(*_KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        for table in (t for level in self.levels for t in level):
            settled = self.spark.table(table).where(F.col("docs") >= self.min_docs).select(*_KEY)
            batch = batch.join(settled, _KEY, "left_anti")
        self._store(batch, 0)

    def shared(self) -> DataFrame:
        """Keys in at least ``min_docs`` documents, with their highest document; written out."""
        found = self._merged([t for level in self.levels for t in level]).where(F.col("docs") >= self.min_docs)
        return stage(found.select(*_KEY, "last"), "shared-lines")

    def close(self) -> None:
        for table in (t for level in self.levels for t in level):
            self.spark.sql(f"DROP TABLE {table}")
        self.levels = []


def drop_shared_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2, carry: bool = False
) -> DataFrame:
    """Per row: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` (text).

    Lines whose key (see ``line_key``) has at least ``min_chars`` characters and stands in at least
    ``min_docs`` documents go, except from the document with the highest id that has it. The
    other lines stay as they are, joined by line feeds. Keys are compared by two 64-bit hashes.

    A null or empty text is one empty line. Rows with the same id are one document. A null id counts as one
    document, lower than all others. Repeated rows give repeated results; an empty table gives none.
    ``carry`` adds the whole row as ``row``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = [whole_row(docs)] if carry else []
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *rows)
    base = base.withColumn("t", F.xxhash64("text"))
    lines = base.select("doc_id", "t", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.where(F.char_length(F.btrim("line", F.lit(_BLANKS))) >= min_chars).withColumn("key", line_key(F.col("line")))
    lines = stage(lines.select("doc_id", "t", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), "line-hashes")

    cuts = lines.approxQuantile("doc_id", [i / batches for i in range(batches - 1, 0, -1)], 0.01) if batches > 1 else []
    runs, above = LineRuns(spark, min_docs, fanout), None
    for cut in [*(int(c) for c in cuts), None]:
        part = lines if cut is None else lines.where(F.col("doc_id") > cut)
        if above is not None:
            part = part.where((F.col("doc_id") <= above) | F.col("doc_id").isNull()) if cut is None else part.where(F.col("doc_id") <= above)
        runs.add(part.select("h1", "h2", "doc_id"))
        above = above if cut is None else cut
    shared = runs.shared()
    runs.close()

    gone = lines.join(shared, _KEY).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    gone = gone.groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(F.array_sort(F.collect_set("place")).alias("gone"))
    held = base.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left")
    passed = ["doc_id", *(["row"] if carry else [])]
    held = held.select(*passed, "text", F.split("text", "\n").alias("lines"), "gone")
    # lines between two dropped ones are kept as a slice, so the work is in proportion to the lines
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("lines")))
    held = held.select(*passed, "text", "lines", "gone", F.when(F.col("gone").isNotNull(), edges).alias("edges"))
    between = F.transform(
        F.sequence(F.lit(0), F.size("edges") - 2),
        lambda i: F.slice("lines", F.get("edges", i) + 2, F.get("edges", i + 1) - F.get("edges", i) - 1),
    )
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(between), "\n"))
    return held.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"), *passed[1:],
    )
