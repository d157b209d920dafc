"""Large JSON arrays in any layout, cut over tasks.

A file is read up to each ``}``, so Spark deals byte ranges of it, its chunks, to tasks. What a piece of text
does to the reader's state is known for both ways of entering it, inside a string or outside: the quotes it
holds, the braces and the brackets it opens or closes. These sums combine associatively. Within a chunk they
run over its segments; over chunks they run over one row per chunk; so every segment learns where it stands
though no task has read what comes before, and an element ends where no brace is open and one bracket is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

SEGMENT_END = "}"
_BLANKS = " \t\r\n"
_CHUNK = ["_file", "_block"]
_SUMS = ["_quotes", "_braces0", "_brackets0", "_braces1", "_brackets1"]


def _segments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text up to each ``}``, by chunk, with what it does to the state when entered outside (0) or inside (1) a string.

    A backslash before ``}`` is no JSON, so no escape is cut in two.
    """
    read = spark.read.option("lineSep", SEGMENT_END).text(paths).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_modification_time").alias("_written"), F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_at"), "value",
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    entered = F.regexp_replace(bare, r'^[^"]*+("|\z)', "")
    outside = [F.regexp_replace(text, r'"[^"]*+("|\z)', "") for text in (bare, entered)]
    many = lambda text, mark: F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))
    odd = many(bare, '"') % 2
    closing = (1 - odd, odd)  # whether the brace that ends the segment stands outside strings
    sums = {"_quotes": many(bare, '"')}
    for inside, text in enumerate(outside):
        sums[f"_braces{inside}"] = many(text, "{") - closing[inside]
        sums[f"_brackets{inside}"] = many(text, "[") - many(text, "]")
    return read.select("*", *(value.cast("long").alias(name) for name, value in sums.items()))


def _chosen(name: str, inside: Column) -> Column:
    return F.when(inside == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


def _in_chunk() -> WindowSpec:
    return Window.partitionBy(*_CHUNK).orderBy("_at")


def _sum_before(name: str | Column, window: WindowSpec | None = None) -> Column:
    rows = (_in_chunk() if window is None else window).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(rows), F.lit(0))


def _chunks(segments: DataFrame) -> DataFrame:
    """A row per chunk: the state in which it is entered, whether it is the first or last, and whether its file is whole."""
    narrow = segments.select(*_CHUNK, "_at", "_size", F.octet_length("value").alias("_bytes"), *_SUMS)
    within = narrow.withColumn("_inside", _sum_before("_quotes") % 2)
    total = lambda name, flip: F.sum(_chosen(name, (F.col("_inside") + flip) % 2)).alias(f"{name}{flip}")
    each = within.groupBy(*_CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_bytes").alias("_bytes"), F.max("_size").alias("_size"), F.sum("_quotes").alias("_quotes"),
        *(total(name, flip) for name in ("_braces", "_brackets") for flip in (0, 1)),
    )
    order = Window.partitionBy("_file").orderBy("_block")
    whole = Window.partitionBy("_file")
    each = each.withColumn("_inside", _sum_before("_quotes", order) % 2)
    for name in ("_braces", "_brackets"):
        each = each.withColumn(name, _chosen(name, F.col("_inside")))
    # the last segment is ended by the file and not by a brace, which was counted all the same
    ended = F.sum("_bytes").over(whole) + F.sum("_n").over(whole) - 1 == F.col("_size")
    closed = (F.sum("_quotes").over(whole) % 2 == 0) & (F.sum("_braces").over(whole) == -1) & (F.sum("_brackets").over(whole) == 0)
    return each.select(
        *(F.col(c).alias(c + "_") for c in _CHUNK), F.col("_n").alias("_segments"), F.col("_inside").alias("_entered"),
        _sum_before("_braces", order).alias("_braces"), _sum_before("_brackets", order).alias("_brackets"),
        F.row_number().over(order).alias("_number"), F.lead("_block").over(order).isNull().alias("_final"), (ended & closed).alias("_whole"),
    )


def array_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every element of the arrays in ``paths`` as the text of a small array: ``value``, ``_file``, ``_written``.

    Elements that are no records come together with the record after them. ``value`` is empty where the
    text cannot belong to one array that is the whole file: something before or behind it, a bracket or
    brace that is missing or left over, a comma too few or too many. Whether an element itself is JSON
    is for the caller to see. Files are read twice, the second time with their text exchanged by
    chunk; only elements that chunks share are exchanged again.
    """
    segments = _segments(spark, paths)
    chunks = _chunks(segments)
    placed = segments.join(chunks, (F.col("_file") == F.col("_file_")) & (F.col("_block") == F.col("_block_")))
    placed = placed.repartition(*_CHUNK).withColumn("_inside", (F.col("_entered") + _sum_before("_quotes")) % 2)
    now = lambda name: F.col(name) + F.sum(_chosen(name, F.col("_inside"))).over(_in_chunk().rowsBetween(Window.unboundedPreceding, 0))
    ends = ((F.col("_inside") + F.col("_quotes")) % 2 == 0) & (now("_braces") == 0) & (now("_brackets") == 1)
    last = F.col("_final") & (F.row_number().over(_in_chunk()) == F.col("_segments"))
    placed = placed.select(*_CHUNK, "_at", "value", "_written", "_number", "_whole", "_entered", "_braces", "_brackets", last.alias("_last"), (ends | last).alias("_ends"))
    placed = placed.withColumn("_element", _sum_before(F.col("_ends").cast("int")))
    pieces = placed.groupBy(*_CHUNK, "_element").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "value"))), lambda s: s["value"]), SEGMENT_END).alias("value"),
        F.max("_last").alias("_last"), F.max("_ends").alias("_ends"),
        *(F.first(c).alias(c) for c in ("_written", "_number", "_whole", "_entered", "_braces", "_brackets")),
    )
    fresh = (F.col("_entered") == 0) & (F.col("_braces") == 0) & (F.col("_brackets") == 1)
    pieces = pieces.select(
        *_CHUNK, "_element", "_written", "_whole", "_last", "_ends",
        F.concat("value", F.when(F.col("_last"), "").otherwise(SEGMENT_END)).alias("value"),
        ((F.col("_number") == 1) & (F.col("_element") == 0)).alias("_first"),
        (F.col("_ends") & ((F.col("_element") > 0) | (F.col("_number") == 1) | fresh)).alias("_complete"),
    )
    columns = ["_file", "_written", "_whole", "_first", "_last", "value"]
    in_file = Window.partitionBy("_file").orderBy("_block", "_element")
    shared = pieces.where(~F.col("_complete")).withColumn("_glue", _sum_before(F.col("_ends").cast("int"), in_file))
    glued = shared.groupBy("_file", "_glue").agg(
        F.first("_written").alias("_written"), F.first("_whole").alias("_whole"), F.max("_first").alias("_first"), F.max("_last").alias("_last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_element", "value"))), lambda s: s["value"]), "").alias("value"),
    )
    every = pieces.where("_complete").select(*columns).union(glued.select(*columns))
    return every.select(F.when(F.col("_whole"), _as_array()).otherwise("").alias("value"), "_file", "_written")


def _as_array() -> Column:
    """A piece with the bracket it lacks on either side and without the comma before it."""
    bare = F.btrim("value", F.lit(_BLANKS))
    inner = F.substr(bare, F.lit(2))
    opened = F.when(F.col("_first") & bare.startswith("["), bare).when(~F.col("_first") & bare.startswith(","), F.concat(F.lit("["), inner))
    nothing_more = ~F.col("_first") & F.col("_last") & (bare == "]")
    comma_only = ~F.col("_first") & bare.rlike(r"^,\s*\]?$")
    closed = F.when(~F.col("_last"), F.concat(opened, F.lit("]"))).when(bare.endswith("]"), opened)
    return F.coalesce(F.when(nothing_more, "[]").when(~comma_only, closed), F.lit(""))
