"""Reading texts out of DataFrames and Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_row(docs: DataFrame) -> Column:
    """All columns as the struct ``row``, where their names clash with nothing."""
    names = [c.replace("`", "``") for c in docs.columns]
    return F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id`` (long) and ``text``; with ``carry`` also the whole row as the struct ``row``.

    Other columns are not read without ``carry``, and with it they cannot clash with results.
    """
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if carry:
        columns.append(whole_row(docs))
    return docs.select(*columns)


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (or binaries), and where each begins (one entry more); null reads as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces_of(batch: pa.RecordBatch, limit: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Neighbouring rows with about ``limit`` bytes of text; a longer text comes alone."""
    _, offsets = utf8(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
