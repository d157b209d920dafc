"""Byte-pair encoding and decoding with an automaton over tokens.

The automaton starts with one state that reads any byte. Every merge (u, v) -> w, in order of
rank, adds a gadget: the arcs labelled u now lead to a copy of their old target that has no arc v
(so u followed by v can no longer be read), and every state that reads u gets an arc w to the
target of v. What remains readable is exactly the token sequences that the merges produce, one
for each string; so encoding is a walk over arcs and needs no merging at all.

Writing the copies out would take (merges + 1) times (tokens) arcs, so the gadgets themselves are the
table. The state after token t has gone through the gadgets whose u is t, and before t was made
through those of its right half, of that one's right half, and so on. The arc x of that state is
lost if such a gadget took x itself or, before x was made, its left half, that one's left half, and
so on. A few look-ups in the table of gadgets, remembered per pair, answer whether an arc is there.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from moonstride.llm.columns import texts_of
from moonstride.llm.memories import forget_others, remembered_by

# a worker remembers this many pieces of text twice over: those met since the last change of
# memories, and those met before it
REMEMBERED_PIECES = 300_000
REMEMBERED_PAIRS = 1_000_000

_SPACE_THEN_SPACE = re.compile(r"\s[ \n]")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?=\s)")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Automaton:
    """Labels are 0-255 for bytes and 256 + rank for merges; the state after a token carries its label."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]) -> None:
        label = {bytes([b]): b for b in range(256)}
        self.text = [bytes([b]) for b in range(256)]
        self.left, self.right = list(range(256)), list(range(256))
        self.gadget: dict[tuple[int, int], int] = {}  # (u, v) -> label of w; labels grow with rank
        self.known: dict[int, bool] = {}
        for u_text, v_text in merges:
            u, v, w, whole = label[u_text], label[v_text], len(self.text), u_text + v_text
            if whole in label:
                raise ValueError(f"two merges make {whole!r}")
            reachable = self._arc(u, v)
            self.text.append(whole)
            self.left.append(u)
            self.right.append(v)
            if reachable:
                self.gadget[u, v] = label[whole] = w
        self.ids = [ids.get(t, -1) for t in self.text]
        self.whole = label
        self.arcs: tuple[int, dict] = (-1, {})  # by next byte: label that ends here or -1, and what can follow
        for t in sorted(label):  # a text comes before those that go on from it
            after = self.arcs[1]
            for b in t[:-1]:
                after = after.setdefault(b, (-1, {}))[1]
            after[t[-1]] = (label[t], {})
        self.id_text = {i: t for t, i in ids.items()}

    def _arc(self, token: int, label: int) -> bool:
        left, right, gadget, last = self.left, self.right, self.gadget, len(self.text)
        u, u_until = token, last
        while True:
            v, v_until = label, last
            while True:
                made = gadget.get((u, v))
                if made is not None and made < u_until and made <= v_until:
                    return False
                if v < 256:
                    break
                v_until, v = v, left[v]
            if u < 256:
                return True
            u_until, u = u, right[u]

    def reads(self, token: int, label: int) -> bool:
        """Whether the state after ``token`` has an arc ``label``."""
        pair = token << 32 | label
        found = self.known.get(pair)
        if found is None:
            if len(self.known) >= REMEMBERED_PAIRS:
                self.known.clear()
            found = self.known[pair] = self._arc(token, label)
        return found

    def walk(self, word: bytes) -> list[int]:
        """Labels of the one path that spells ``word``: the longest arc first, going back where it ends blind."""
        whole = self.whole.get(word)
        if whole is not None:
            return [whole]
        arcs, reads, text, n = self.arcs[1], self.reads, self.text, len(word)
        path: list[int] = []
        tried: list[list[int]] = []  # per place: arcs not tried yet, the longest last
        blind = set()  # places from which no path goes on
        at = 0
        while at < n:
            open_arcs = []
            after = arcs
            for b in word[at:]:
                node = after.get(b)
                if node is None:
                    break
                found, after = node
                if found >= 0:
                    open_arcs.append(found)
            tried.append(open_arcs)
            while True:
                open_arcs = tried[-1]
                found = -1
                while open_arcs:
                    found = open_arcs.pop()
                    if at + len(text[found]) not in blind and (not path or reads(path[-1], found)):
                        break
                    found = -1
                if found >= 0:
                    path.append(found)
                    at += len(text[found])
                    break
                blind.add(at)
                tried.pop()
                at -= len(text[path.pop()])
        return path


def split_pieces(text: str) -> list[str]:
    """Cut where a visible character is followed by white space: there byte-level BPE always parts two words."""
    if "\x00" in text or _SPACE_THEN_SPACE.search(text):
        return _BEFORE_SPACE.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")


class Codec(dict):
    """From pieces of text to their ids as little-endian 32-bit integers; remembers pieces already walked."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.older: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, before = described["model"], described["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or described["normalizer"]:
            raise ValueError("only byte-level BPE without normaliser and prefix space is read")
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        spell = lambda token: bytes(byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = {spell(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.automaton = Automaton([(spell(a), spell(b)) for a, b in pairs], ids)
        # fixed value: the pattern that splits texts before byte-level merges
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", regex.V0)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.label_of_id = {**self.automaton.id_text, **{i: t.encode() for t, i in self.special.items()}}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids, walk = self.automaton.ids, self.automaton.walk
            found = [ids[label] for word in self.words.findall(piece) for label in walk(word.encode())]
            packed = pack(f"<{len(found)}I", *found)
        if len(self) >= REMEMBERED_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, split_pieces(text)))

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian 32-bit integers; special tokens written out become theirs."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut.split(text)
        return b"".join(
            np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p) for p in parts
        )

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, joined; bytes that are no UTF-8 become U+FFFD."""
        labels = self.label_of_id
        return b"".join(map(labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a tokenizer file, built once per worker."""
    remembered_by(__name__, codec.cache_clear)
    return Codec(path)


def encode_and_decode(docs: DataFrame, tokenizer_path: str, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids`` and ``decoded``.

    ``tokenizer_path`` is a byte-level BPE file that every executor has. A null or empty text has
    no tokens and decodes to the empty text. A null id stays null; repeated rows give repeated
    results; an empty table gives none; other columns are not read. Rows never meet, so nothing
    is shuffled, and a task holds one text and its ids at a time besides the automaton.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids + [("decoded", pa.string())] * with_text
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        coder = codec(tokenizer_path)
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = coder.encode(text.as_py() or "")
                decoded = coder.decode(ids)
                row = [doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                row += [np.frombuffer(ids, "<i4").tolist()] * with_ids + [decoded] * with_text
                for column, value in zip(rows, row):
                    column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema)

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    kinds += ", ids array<int>" * with_ids + ", decoded string" * with_text
    return texts_of(docs).mapInArrow(run, kinds)
