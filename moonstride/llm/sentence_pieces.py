"""SentencePiece encoding of merge-type models by backtracking, and decoding.

A sequence of pieces is what the merges make of its text exactly if every two neighbours are what the
merges make of theirs. So the longest piece at each place is tried first (one Aho-Corasick pass finds
them all); a piece that does not go with the one before it gives way to its longest shorter prefix;
a place from which nothing goes on is marked in a bitfield and never entered again. Whether two pieces
go together is found by merging their joined characters anew, and remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack, unpack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from moonstride.llm.columns import texts_of
from moonstride.llm.memories import forget_others, remembered_by

SPACE = "▁"
# a worker remembers this many runs of text twice over (those met since the last change of memories, and those
# met before it) and this many pairs of pieces; longer runs are encoded anew
REMEMBERED_RUNS = 350_000
REMEMBERED_PAIRS = 1_000_000
LONGEST_REMEMBERED = 64
# kinds of pieces in a model file (fixed values)
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        width = {0: None, 1: 8, 5: 4}.get(key & 7, -1)
        if width is None:
            yield key >> 3, number()
            continue
        width = number() if width < 0 else width
        yield key >> 3, data[at : at + width]
        at += width


class _Runs(dict):
    """What runs of text become, worked out by ``find`` when first met and remembered."""

    def __init__(self, find: Callable[[str], tuple]) -> None:
        super().__init__()
        self.find, self.older = find, {}

    def __missing__(self, text: str) -> tuple:
        found = self.older.get(text) or self.find(text)
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_RUNS:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


class PieceModel:
    """A merge-type model with the identity normaliser, read from its file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        trainer = dict(_fields(b"".join(v for f, v in parts if f == 2)))
        normalizer = dict(_fields(b"".join(v for f, v in parts if f == 3)))
        pieces = [dict(_fields(v)) for f, v in parts if f == 1]
        texts = [p[1].decode() for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        plain = normalizer.get(1, b"identity") == b"identity" and not normalizer.get(2) and not normalizer.get(4, 1)
        if trainer.get(3) != 2 or not plain or trainer.get(24) or not normalizer.get(5, 1):
            raise ValueError("only merge-type models with the identity normaliser and all white space kept are read")
        if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with user-defined or unused pieces are not read")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.id_of = {t: i for i, (t, k) in enumerate(zip(texts, kinds)) if k == NORMAL}
        self.score = {t: unpack("<f", pieces[i][2])[0] for t, i in self.id_of.items()}
        self.byte_id = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(texts, kinds)) if k == BYTE} if trainer.get(35) else {}
        self.unknown = kinds.index(UNKNOWN)
        self.label = [t.replace(SPACE, " ").encode() if k == NORMAL else b"" for t, k in zip(texts, kinds)]
        for byte, i in self.byte_id.items():
            self.label[i] = bytes([byte])
        self.label[self.unknown] = trainer.get(44, b" \xe2\x81\x87 ")
        self.silent = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.is_byte = set(self.byte_id.values())
        self._pairs: dict[tuple[str, str], bool] = {}
        self._runs = _Runs(self._run)
        # what the merges never leave standing is never tried
        self.pieces = {t for t in self.id_of if len(t) == 1 or self.merged(t) == [t]}
        self.matcher = ahocorasick.Automaton()
        for t in self.pieces:
            self.matcher.add_word(t[::-1], len(t))
        self.matcher.make_automaton()
        self.shorter: dict[str, str | None] = {}
        self.runs = self._run_pattern()

    def _run_pattern(self) -> re.Pattern | None:
        """Cuts text where no piece can reach across; None if pieces go on with a blank.

        Cut out are blanks with the letters after them, characters that join nothing, and marks that join no letter.
        """
        joined = {t for t in self.id_of if len(t) > 1}
        if any(SPACE in t.lstrip(SPACE) for t in joined):
            return None
        beside: dict[str, set[str]] = {}
        for t in joined:
            for a, b in zip(t, t[1:]):
                beside.setdefault(a, set()).add(b)
                beside.setdefault(b, set()).add(a)
        lone = {c for c in map(chr, range(128)) if c not in beside}
        marks = {c for c in beside if not c.isalpha()} - {SPACE}
        while others := {c for c in marks if not beside[c] <= marks | {SPACE}}:
            marks -= others
        written = lambda chars: "".join(map(re.escape, sorted(chars)))
        kinds = [f"{SPACE}*[^{SPACE}{written(lone | marks)}]+"]
        kinds += [f"{SPACE}*[{written(marks)}]+"] * bool(marks) + [f"{SPACE}+"] + [f"[{written(lone)}]"] * bool(lone)
        return re.compile("|".join(kinds))

    def merged(self, text: str) -> list[str]:
        """The merges applied to single characters: best score first, the leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, place = None, -1
            for at in range(len(parts) - 1):
                found = score.get(parts[at] + parts[at + 1])
                if found is not None and (best is None or found > best):
                    best, place = found, at
            if place < 0:
                return parts
            parts[place : place + 2] = [parts[place] + parts[place + 1]]

    def together(self, first: str, second: str) -> bool:
        """Whether the merges leave ``second`` standing after ``first``."""
        pair = (first, second)
        found = self._pairs.get(pair)
        if found is None:
            if len(self._pairs) >= REMEMBERED_PAIRS:
                self._pairs.clear()
            found = self._pairs[pair] = self.merged(first + second) == [first, second]
        return found

    def _prefix_of(self, piece: str) -> str | None:
        """The longest shorter piece that ``piece`` begins with; a single character always is one."""
        found = self.shorter.get(piece, "")
        if found == "":
            found = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if n == 1 or piece[:n] in self.pieces), None)
            self.shorter[piece] = found
        return found

    def split(self, text: str) -> list[str]:
        """Pieces of ``text`` (blanks written as ``SPACE``), unknown characters alone."""
        if text in self.pieces or not text:
            return [text] * bool(text)
        n = len(text)
        longest = [1] * n  # by place from the end
        for end, size in self.matcher.iter(text[::-1]):
            if size > longest[end]:
                longest[end] = size
        failed = bytearray(n // 8 + 1)
        path: list[str] = []
        pairs, pieces, prefix_of = self._pairs, self.shorter, self._prefix_of
        at, last, piece = 0, None, text[: longest[n - 1]]
        while True:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    good = pairs.get((last, piece))
                    if good or (good is None and self.together(last, piece)):
                        break
                piece = pieces.get(piece) or prefix_of(piece)
            if piece is not None:
                path.append(piece)
                if end == n:
                    return path
                at, last = end, piece
                piece = text[at : at + longest[n - 1 - at]]
                continue
            failed[at >> 3] |= 1 << (at & 7)
            piece = path.pop()
            at -= len(piece)
            last = path[-1] if path else None
            piece = prefix_of(piece)

    def _ids(self, text: str) -> list[int]:
        ids = []
        for piece in self.split(text):
            found = self.id_of.get(piece)
            if found is not None:
                ids.append(found)
            elif self.byte_id:
                ids += [self.byte_id[b] for b in piece.encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def _run(self, text: str) -> tuple[str, bytes, str]:
        ids = self._ids(text)
        return ",".join(map(str, ids)), pack(f"<{len(ids)}I", *ids), self._spell(ids)

    def encode(self, text: str) -> list[tuple[str, bytes, str]]:
        """Per run of ``text``: its ids as decimals joined by commas, as little-endian 32-bit integers, and decoded."""
        if not text:
            return []
        text = (self.prefix + text).replace(" ", SPACE)
        if self.runs is None or not self.byte_id:  # unknown runs across a cut count as one
            return [self._run(text)]
        return list(map(self._runs.__getitem__, self.runs.findall(text)))

    def encode_and_decode(self, text: str) -> tuple[str, bytes, str]:
        """Ids of ``text`` in both forms, and what they decode to.

        No character is cut by a run, so its ids decode to the same text alone and among others.
        """
        runs = self.encode(text)
        decoded = "".join([r[2] for r in runs])
        return ",".join([r[0] for r in runs]), b"".join([r[1] for r in runs]), decoded[bool(self.prefix) :]

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; the blank put before a text is taken off, stray bytes become U+FFFD."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        parts = [numbers]
        if not self.silent.isdisjoint(numbers):  # control pieces say nothing, but bytes do not join across them
            parts = [[]]
            for i in numbers:
                parts.append([]) if i in self.silent else parts[-1].append(i)
        first = next((p[0] for p in parts if p), None)
        text = "".join(map(self._spell, parts))
        blank = self.prefix and first is not None and first not in self.is_byte and first != self.unknown
        return text[1:] if blank and text.startswith(" ") else text

    def _spell(self, numbers: list[int]) -> str:
        raw = b"".join(map(self.label.__getitem__, numbers))
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "stray")


def _stray(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """The model of a file, built once per worker."""
    remembered_by(__name__, piece_model.cache_clear)
    import codecs

    codecs.register_error("stray", _stray)
    return PieceModel(path)


def encode_and_decode(docs: DataFrame, model_path: str, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of decimals joined by commas), ``decoded_sha256``.

    ``with_ids`` adds ``ids``, ``with_text`` adds ``decoded``. ``model_path`` is a merge-type model with the
    identity normaliser that every executor has; another kind ends in an error that says so. A null or
    empty text has no tokens and decodes to the empty text. A null id stays null; repeated rows give
    repeated results; an empty table gives none; other columns are not read. Rows never meet, so nothing
    is shuffled. A text without blanks, however long, is one run: its places take a few bytes each.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids + [("decoded", pa.string())] * with_text
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        model = piece_model(model_path)
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                decimals, packed, decoded = model.encode_and_decode(text.as_py() or "")
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in (decimals, decoded)]
                row = [doc_id, len(packed) // 4, *digests]
                row += [np.frombuffer(packed, "<i4").tolist()] * with_ids + [decoded] * with_text
                for column, value in zip(rows, row):
                    column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema)

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    kinds += ", ids array<int>" * with_ids + ", decoded string" * with_text
    return texts_of(docs).mapInArrow(run, kinds)
