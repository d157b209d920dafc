"""Pieces of text and the library: what it is asked, what is remembered, and where words are cut."""

import json
import random
import re

import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from moonstride.llm import token_blocks
from moonstride.llm.queries import TOKENIZER


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def ids(encoder, texts):
    return [memoryview(i).cast("I").tolist() for i in encoder.encode_all(pa.array(texts, pa.string()))]


def expected(texts):
    library = Tokenizer.from_file(TOKENIZER)
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def characters(of):
    """All characters of a class written as ranges."""
    ranges = re.findall(r"\\?(.)-\\?(.)|\\?(.)", of)
    return [chr(c) for a, z, one in ranges for c in (range(ord(a), ord(z) + 1) if a else [ord(one)])]


def test_new_words_reach_the_library_together():
    rng = random.Random(3)
    words = {"".join(rng.choices("etaoinshré", k=9)) for _ in range(3000)}
    text = "".join(f" {w}{rng.choice(['', '.', ',', ')', '%%%'])}" for w in sorted(words))
    encoder = token_blocks.PieceEncoder(TOKENIZER)
    encoder.tokenizer = whole = Counted(encoder.tokenizer)
    if getattr(encoder, "words", None):
        encoder.words = model = Counted(encoder.words)
    assert ids(encoder, [text]) == expected([text])
    assert whole.texts < 10 and model.texts < 10


def test_known_words_are_not_asked_again():
    encoder = token_blocks.PieceEncoder(TOKENIZER)
    first = ids(encoder, ["some words, and\tsome more كتابٌ"])
    encoder.words = encoder.tokenizer = None
    assert ids(encoder, ["some words, and\tsome more كتابٌ"]) == first


@pytest.mark.parametrize("limit", [0, 4000, 32 << 20])
def test_odd_texts_and_short_memory(limit):
    rng = random.Random(limit)
    parts = [
        " ", " ", " ", "\n", "\n\n", "  ", "\t", "\r\n", "\x00", " ", "　", " ", "a", "the", "The", "été", "straße", "'s", "'", "'re", "''ll", "’t", "'S",
        "12", "٣", "x²", "½", ".", "...", "!?", "&&&", "—", "“q”", "日本語", "カナ", "한국", "слово", "҃", "λόγος", "ὀδός", "كتاب", "كِتاب", "שלום", "नमस्ते", "é",
        "\U0001f600", "_", "~", "ǅ", "ª", "µ", "×", "÷", "İ", "<|endoftext|>", "<|", "Ġ", "Ċ", "​", "﻿",
    ]
    encoder = token_blocks.PieceEncoder(TOKENIZER, limit)
    for _ in range(12):
        texts = [None, "", *("".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(150))]
        assert ids(encoder, texts) == expected(texts)
        assert encoder._bytes() <= limit
    assert ids(encoder, []) == []
    sliced = pa.array(["before", "a b", None, "c\td  e"]).slice(1)
    assert [len(i) // 4 for i in encoder.encode_all(sliced)] == [len(i) for i in expected(["a b", "", "c\td  e"])]


def test_every_plain_character_is_what_the_library_takes_it_for():
    cut = lambda text: len(ByteLevel(add_prefix_space=False).pre_tokenize_str(text))
    letters, others = characters(token_blocks._LETTERS), characters(token_blocks._OTHERS)
    assert len(letters) > 30_000 and {"a", "ÿ", "龥"} < set(letters) and {"'", "\\", "]", "~", "°"} < set(others)
    assert cut("".join(letters)) == cut("".join(others)) == 1
    assert cut("a" + "".join(others)) == 2


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_other_tokenizers_go_through_the_whole_library(tmp_path, change):
    with open(TOKENIZER, encoding="utf-8") as file:
        described = json.load(file)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(described | change), encoding="utf-8")
    assert token_blocks.PieceEncoder(str(path)).words is None
    assert token_blocks.PieceEncoder(TOKENIZER).words is not None
