"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of neighbouring documents, in order, cut into blocks of ``BLOCK`` ids. A
block stores its minimum, the differences to it packed at the width that a percentile of them
needs, and the wider ones in a list of exceptions. Behind the blocks come the index of block
starts, the table of documents (id, tokens) and a footer, so any document can be read alone.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moonstride.llm.bpe_automaton import byte_letters, split_pieces
from moonstride.llm.columns import pieces_of, texts_of, utf8
from moonstride.llm.memories import forget_others, remembered_by
from moonstride.session import scratch_path, stage

BLOCK = 1024
_LANES = BLOCK // 64
_MAGIC = b"PFORIDS1"
_HEAD = np.dtype([("minimum", "<u4"), ("n", "<u2"), ("outliers", "<u2"), ("width", "u1"), ("spare", "u1", 3)])
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<i8")])
_FOOT = np.dtype([("blocks", "<u8"), ("docs", "<u8"), ("ids", "<u8"), ("magic", "S8")])
# blocks packed at a time
_TOGETHER = 256
# characters of a kind that all versions of Unicode agree on: letters, and what is neither letter, number nor space
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁҊ-ԯא-תء-غف-يぁ-ゖァ-ヺ一-龥가-힣"
_OTHERS = r"!-/:-@\[-`{-~“”‘’–—…«»¡¿•€£§°"
# pieces of these alone are cut into words by Arrow, as the pattern of byte-level BPE cuts them
_PLAIN = rf"\A[ \n]?[{_LETTERS}0-9{_OTHERS}]+\z"
_WORD = rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[{_OTHERS}]+|\n"
# plain pieces, and others, handed to the library at a time
_AT_ONCE, _ALONE_AT_ONCE = 50_000, 1_000
# white space before a blank or a line end, and NUL: cut in Python
_ODD = r"\x00|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}][ \n]"


def pack_blocks(ids: np.ndarray, percentile: float = 0.9) -> list[bytes]:
    """Encode ``ids`` (uint32), ``BLOCK`` to a block; the last may be shorter."""
    out: list[bytes] = []
    for first in range(0, len(ids), _TOGETHER * BLOCK):
        part = ids[first : first + _TOGETHER * BLOCK]
        count = -(-len(part) // BLOCK)
        filled = np.full(count * BLOCK, part[-1], np.uint32)
        filled[: len(part)] = part
        values = filled.reshape(count, BLOCK)
        low = values.min(axis=1)
        rest = values - low[:, None]
        at = min(BLOCK - 1, int(percentile * (BLOCK - 1) + 0.999999))
        limit = np.partition(rest, at, axis=1)[:, at]
        widths = np.array([int(x).bit_length() for x in limit], np.uint8)
        packed: list[bytes] = [b""] * count
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            if width:
                mask = np.uint64((1 << width) - 1)
                lanes = (rest[rows].astype(np.uint64) & mask).reshape(len(rows), _LANES, 64)
                words = np.zeros((len(rows), _LANES, width), np.uint64)
                for lane in range(64):
                    word, shift = divmod(lane * width, 64)
                    words[:, :, word] |= lanes[:, :, lane] << np.uint64(shift)
                    if shift + width > 64:
                        words[:, :, word + 1] |= lanes[:, :, lane] >> np.uint64(64 - shift)
                for row, content in zip(rows.tolist(), words):
                    packed[row] = content.astype("<u8").tobytes()
        wide = rest >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
        for row in range(count):
            n = min(BLOCK, len(part) - row * BLOCK)
            where = np.flatnonzero(wide[row, :n])
            head = np.zeros(1, _HEAD)
            head["minimum"], head["n"], head["outliers"], head["width"] = low[row], n, len(where), widths[row]
            out.append(head.tobytes() + packed[row] + where.astype("<u2").tobytes() + rest[row, where].astype("<u4").tobytes())
    return out


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of neighbouring blocks, which begin at ``starts`` in ``data``; blocks of one width are unpacked together."""
    heads = np.concatenate([np.frombuffer(data, _HEAD, 1, at) for at in starts.tolist()])
    rest = np.zeros((len(heads), BLOCK), np.uint32)
    for width in np.unique(heads["width"]).tolist():
        rows = np.flatnonzero(heads["width"] == width)
        if not width:
            continue
        size = 8 * _LANES * width
        words = b"".join([data[at : at + size] for at in (starts[rows] + _HEAD.itemsize).tolist()])
        words = np.frombuffer(words, "<u8").reshape(len(rows) * _LANES, width).T.copy()
        lanes, mask = np.empty((64, len(rows) * _LANES), np.uint64), np.uint64((1 << width) - 1)
        for lane in range(64):
            word, shift = divmod(lane * width, 64)
            value = words[word] >> np.uint64(shift)
            if shift + width > 64:
                value |= words[word + 1] << np.uint64(64 - shift)
            np.bitwise_and(value, mask, out=lanes[lane])
        rest[rows] = lanes.T.reshape(len(rows), BLOCK)
    for row in np.flatnonzero(heads["outliers"]).tolist():
        outliers, at = int(heads["outliers"][row]), int(starts[row]) + _HEAD.itemsize + 8 * _LANES * int(heads["width"][row])
        rest[row, np.frombuffer(data, "<u2", outliers, at)] = np.frombuffer(data, "<u4", outliers, at + 2 * outliers)
    rest += heads["minimum"][:, None]
    return rest[np.arange(BLOCK) < heads["n"][:, None]]


def _cuts_as_expected(path: str) -> bool:
    """Whether texts are cut by the pattern of byte-level BPE as they are, and words have no marks of their own."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    before, model = described.get("pre_tokenizer") or {}, described["model"]
    return (
        (before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True)) == ("ByteLevel", False, True)
        and model["type"] == "BPE" and not described.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    )


class PieceEncoder:
    """From distinct pieces of text to their ids, through the tokenizers library.

    Plain pieces are cut into words here, spelled in byte letters and given to the library's model many at
    a time; other pieces go through the whole library one by one. Both are remembered as columns of at most
    ``limit`` bytes; beyond them, only those of the last call are.
    """

    def __init__(self, path: str, limit: int = 32 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spelled, vocab = byte_letters(), self.tokenizer.get_vocab()
        self.letters = np.array([ord(c) for c in spelled], "<u4")
        self.letters[ord("\t")] = ord("\t")  # between words
        self.spans = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token
        self.spans[list(vocab.values())] = list(map(len, vocab))
        self.words = None  # the model alone, for spelled words
        if _cuts_as_expected(path) and all(c in vocab for c in spelled):
            self.words = Tokenizer(self.tokenizer.model)
            self.words.pre_tokenizer = CharDelimiterSplit("\t")
        self._forget()

    def _forget(self) -> None:
        self._remember(pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _remember(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.pieces, self.ids, self.sizes, self.starts = pieces, ids, sizes, np.cumsum(sizes) - sizes

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and how many each has, by the whole library."""
        found, sizes = array("I"), []
        for first in range(0, len(texts), _ALONE_AT_ONCE):
            for encoded in self.tokenizer.encode_batch_fast(texts[first : first + _ALONE_AT_ONCE], add_special_tokens=False):
                found.fromlist(ids := encoded.ids)
                sizes.append(len(ids))
        return np.array(found, np.uint32), np.array(sizes, np.int64)

    def _plain_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of plain pieces, by the model; tokens end where pieces do, so their bytes tell how many."""
        words = utf8(pc.replace_substring_regex(pieces, _WORD, "\t\\0"))[0]
        text = self.letters[words].tobytes().decode("utf-32-le")
        ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends, piece_ends = np.cumsum(self.spans[ids]), utf8(pieces)[1][1:]
        last = np.searchsorted(ends, piece_ends)
        if len(ids) != last[-1] + 1 or (ends[last] != piece_ends).any():
            raise ValueError("tokens do not spell the text")
        return ids, np.diff(last, prepend=-1)

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Remember new pieces and return their places."""
        plain = pc.match_substring_regex(new, _PLAIN) if self.words else pa.array(np.zeros(len(new), bool))
        some, rest, plain = new.filter(plain), new.filter(pc.invert(plain)), plain.to_numpy(zero_copy_only=False)
        found = [(self.ids, self.sizes)]
        found += [self._plain_ids(some.slice(first, _AT_ONCE)) for first in range(0, len(some), _AT_ONCE)]
        found.append(self._ids(rest.to_pylist()))
        places = np.empty(len(new), np.int64)
        places[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = len(self.pieces) + np.arange(len(new))
        self._remember(pa.concat_arrays([self.pieces, some, rest]), *(np.concatenate(column) for column in zip(*found)))
        return places

    def _at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the remembered pieces at ``places``, one after another, and where each ends."""
        counts = self.sizes[places]
        ends = np.cumsum(counts)
        return self.ids[np.repeat(self.starts[places] - (ends - counts), counts) + np.arange(len(ends) and ends[-1])], ends

    def ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after another, and where those of each end."""
        numbered = pieces.dictionary_encode()
        distinct = numbered.dictionary.cast(pa.large_string())
        known = pc.index_in(distinct, value_set=self.pieces)
        places, new = known.fill_null(0).to_numpy().astype(np.int64), known.is_null()
        if pc.any(new).as_py():
            places[new.to_numpy(zero_copy_only=False)] = self._learn(distinct.filter(new))
        found = self._at(places[numbered.indices.to_numpy(zero_copy_only=False)])
        if self._bytes() > self.limit:
            self._remember(distinct, self._at(places)[0], self.sizes[places])
            if self._bytes() > self.limit:
                self._forget()
        return found

    def _bytes(self) -> int:
        return self.pieces.nbytes + self.ids.nbytes + self.sizes.nbytes + self.starts.nbytes

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text (null: none).

        Arrow cuts the texts and numbers their distinct pieces, only those are looked up, and their ids
        are gathered by number. Texts with special tokens written out go to the library whole; those with
        white space that Arrow would cut elsewhere are cut in Python.
        """
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        special = pa.array(np.zeros(len(texts), bool))
        for content in self.special:
            special = pc.or_(special, pc.match_substring(texts, content))
        marked = pc.replace_substring(pc.if_else(pc.or_(odd, special), "", texts), " ", "\x00 ")
        pieces = pc.split_pattern(pc.replace_substring(marked, "\n", "\x00\n"), "\x00")
        flat, rows = pieces.flatten(), pieces.offsets.to_numpy()
        cut = {row: split_pieces(texts[row].as_py()) for row in np.flatnonzero(pc.and_not(odd, special)).tolist()}
        ids, ends = self.ids_of(pa.concat_arrays([flat, pa.array([p for found in cut.values() for p in found], flat.type)]))
        ends = np.append(0, ends)
        bounds, place = ends[rows - rows[0]].tolist(), len(flat)
        for row, (first, last, whole) in enumerate(zip(bounds, bounds[1:], special.to_pylist())):
            if whole:
                yield self._ids([texts[row].as_py()])[0].tobytes()
                continue
            if row in cut:
                first, last, place = int(ends[place]), int(ends[place + len(cut[row])]), place + len(cut[row])
            yield ids[first:last].tobytes()


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    remembered_by(__name__, piece_encoder.cache_clear)
    return PieceEncoder(path)


class BlockFile:
    """Writes one file, block after block; documents may span blocks."""

    def __init__(self, path: str) -> None:
        self.store, self.path = fs.FileSystem.from_uri(path)
        self.store.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.store.open_output_stream(self.path)
        self.out.write(_MAGIC)
        self.at, self.starts, self.docs, self.ids = len(_MAGIC), [], [], 0
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self.ids += len(ids) // 4
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= 4 * BLOCK * _TOGETHER:
            self._write(self.waiting_bytes // (4 * BLOCK) * BLOCK)

    def _write(self, count: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        for block in pack_blocks(ids[:count]):
            self.starts.append(self.at)
            self.at += self.out.write(block)
        self.waiting = [ids[count:].tobytes()]
        self.waiting_bytes = len(self.waiting[0])

    def close(self) -> None:
        self._write(self.waiting_bytes // 4)
        self.out.write(np.array([*self.starts, self.at], "<u8").tobytes())
        self.out.write(np.array(self.docs, _DOC).tobytes())
        self.out.write(np.array([(len(self.starts), len(self.docs), self.ids, _MAGIC)], _FOOT).tobytes())
        self.out.close()


def write_blocks(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, unit_ids: int = 1_000_000) -> DataFrame:
    """Encode all texts into block files in ascending order of ``doc_id`` (null first) and return the manifest.

    The manifest has a row per unit, a run of documents with about ``unit_ids`` ids: ``file``,
    ``part`` (order of the files), ``first_doc``, ``n_docs``, ``first_id``, ``n_ids`` (places in
    the file). Files are named anew by every attempt of a task and count only if the manifest names
    them, so repeated and lost tasks do no harm. Rows are range-partitioned by id and then by their
    place in the input, so a repeated id is split like any other. An empty table writes no file.
    """
    rows = texts_of(docs).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("place")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "place"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        encoder, end, file, units = piece_encoder(tokenizer_path), np.array([end_id], "<u4").tobytes(), None, []
        part = TaskContext.get().partitionId()
        for whole in batches:
            for batch in pieces_of(whole, 8 << 20):
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_all(batch.column("text"))):
                    file = file or BlockFile(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.pfor")
                    if not units or file.ids - units[-1][1] >= unit_ids:
                        units.append((len(file.docs), file.ids))
                    file.add(doc_id, ids + end)
        if file:
            file.close()
            first_docs, first_ids = map(np.array, zip(*units))
            yield pa.record_batch(
                {
                    "file": [file.path] * len(units), "part": [part] * len(units),
                    "first_doc": first_docs, "n_docs": np.diff(first_docs, append=len(file.docs)),
                    "first_id": first_ids, "n_ids": np.diff(first_ids, append=file.ids),
                }
            )

    kinds = "file string, part long, first_doc long, n_docs long, first_id long, n_ids long"
    return stage(ordered.mapInArrow(run, kinds), "token-manifest")


def _read_unit(data, at_doc: int, n_docs: int, at_id: int, n_ids: int) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    data.seek(data.size() - _FOOT.itemsize)
    foot = np.frombuffer(data.read(), _FOOT)[0]
    if foot["magic"] != _MAGIC:
        raise ValueError("not a block file")
    blocks, docs = int(foot["blocks"]), int(foot["docs"])
    table = data.size() - _FOOT.itemsize - docs * _DOC.itemsize
    index = table - 8 * (blocks + 1)
    first, last = at_id // BLOCK, -(-(at_id + n_ids) // BLOCK)
    data.seek(index + 8 * first)
    starts = np.frombuffer(data.read(8 * (last - first + 1)), "<u8").astype(np.int64)
    data.seek(table + _DOC.itemsize * at_doc)
    wanted = np.frombuffer(data.read(_DOC.itemsize * n_docs), _DOC)
    place, held, ids = at_id, range(0), None  # ids are those at the places `held`
    for doc in wanted:
        left, parts = int(doc["n"]), []
        while left:
            if place not in held:
                block = place // BLOCK - first
                until = min(block + _TOGETHER, last - first)
                data.seek(int(starts[block]))
                content = data.read(int(starts[until] - starts[block]))
                ids = unpack_blocks(content, starts[block:until] - starts[block])
                held = range((block + first) * BLOCK, (block + first) * BLOCK + len(ids))
            take = ids[place - held.start :][:left]
            parts.append(take)
            place, left = place + len(take), left - len(take)
        yield (None if doc["null"] else int(doc["id"])), parts


def read_blocks(spark: SparkSession, manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents out of block files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    ``manifest`` is what ``write_blocks`` returned. Units are read in parallel, each from the blocks
    it covers. ``ids_crc32`` is taken over the ids as little-endian 32-bit integers.
    """
    files = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = files.select(F.col("part").alias("_part"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    units = manifest.join(starts, F.col("part") == F.col("_part")).drop("_part")
    tasks = max(1, spark.sparkContext.defaultParallelism)
    units = units.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file", "first_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for unit in batch.to_pylist():
                rows: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
                start = unit["before"] + unit["first_id"]
                with store.open_input_file(unit["file"]) as data:
                    for doc_id, parts in _read_unit(data, unit["first_doc"], unit["n_docs"], unit["first_id"], unit["n_ids"]):
                        crc = n = 0
                        for part in parts:
                            crc, n = zlib.crc32(part.astype("<u4").tobytes(), crc), n + len(part)
                        values = [doc_id, start, n, crc] + [[int(i) for part in parts for i in part]] * with_ids
                        for column, value in zip(rows.values(), values):
                            column.append(value)
                        start += n
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
                yield pa.record_batch([pa.array(c, k) for c, k in zip(rows.values(), kinds)], list(rows))

    return units.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def tokens_through_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """Write all texts as block files and read them back; see ``write_blocks`` and ``read_blocks``.

    A null or empty text is the end token alone; null ids come first; repeated rows repeat. The
    folder (default: a new one in the session's shared folder) must be one that pyarrow can open.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-blocks")
    return read_blocks(spark, write_blocks(docs, tokenizer_path, end_id, folder), folder, with_ids)
