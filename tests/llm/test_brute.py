"""Each operator against a plain version, on tricky rows and on whole test tables."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import crc, groups, katz, low, passages, quality, repeats, sha, shared_lines
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moonstride.llm import (
    bpe_automaton,
    decontamination,
    jaccard_trie,
    language_codes,
    line_runs,
    quality_ledger,
    substring_dedup,
    token_blocks,
)
from moonstride.llm import katz as katz_model
from moonstride.llm.columns import crc_of_id

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", params=["tricky", "documents", "nothing"])
def docs(request, llm, tricky, nothing):
    return {"tricky": tricky, "nothing": nothing}.get(request.param) or llm.read.parquet(f"{FOLDER}/documents.parquet")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    order = lambda row: tuple((v is not None, v) for v in row)
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert got == want


def test_encoding_and_decoding(docs):
    library = Tokenizer.from_file(PATH)
    want = []
    for i, text in rows_of(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), sha(decoded), decoded))
    same(bpe_automaton.encode_and_decode(docs, PATH, with_text=True).collect(), want)


def test_token_blocks(docs):
    library, want, start = Tokenizer.from_file(PATH), [], 0
    got = token_blocks.tokens_through_files(docs, PATH, 2).collect()
    rows = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], want)
    places = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert [p[0] for p in places] == [0, *np.cumsum([p[1] for p in places]).tolist()][: len(places)]
    ids = [p[2] for p in places if p[2] is not None]
    assert ids == sorted(ids)


def test_substring_removal(docs):
    same(substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), list(repeats(rows_of(docs))))


def test_short_windows(tricky):
    same(substring_dedup.remove_repeats(tricky, size=3).collect(), list(repeats(rows_of(tricky), 3)))


def test_a_small_sketch_loses_nothing(tricky):
    same(substring_dedup.remove_repeats(tricky, size=5, cells_per_window=0).collect(), list(repeats(rows_of(tricky), 5)))


def test_quality_measurements(docs):
    ledger = quality_ledger.build_ledger(docs)
    same(ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect(), list(quality(rows_of(docs))))
    judged = quality_ledger.apply_policy(ledger, quality_ledger.BASE)
    wrong = judged.where(F.col("kept") == ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))
    assert wrong.count() == 0


def test_ablations(tricky):
    ledger = quality_ledger.build_ledger(tricky)
    bits = [r.failures & quality_ledger.PROSE.mask for r in ledger.collect()]
    got = {r.rule: (r.failed, r.alone, r.kept_without) for r in quality_ledger.ablations(ledger, quality_ledger.PROSE).collect()}
    for rule in quality_ledger.RULES:
        bit = 1 << rule.bit
        assert got[rule.name] == (sum(b & bit > 0 for b in bits), bits.count(bit), sum(b & ~bit == 0 for b in bits))


@pytest.mark.parametrize("batches, fanout", [(4, 2), (1, 2), (6, 3)])
def test_shared_lines(docs, batches, fanout):
    if (batches, fanout) != (4, 2) and docs.limit(201).count() != 200:
        docs = docs.limit(1000)
    found = line_runs.drop_shared_lines(docs, batches=batches, fanout=fanout)
    same(found.select("doc_id", "n_lines", "n_dropped", "kept").collect(), list(shared_lines(rows_of(docs))))


@pytest.mark.parametrize("block_bytes", [8 << 20, 3000])
def test_passages(llm, docs, block_bytes):
    rows = rows_of(docs)
    texts = [t for _, t in rows if t and len(t) > 200][:2]
    items = [(1, texts[0][:150] if texts else "a b"), (2, "ONE"), (2, "ONE"), (None, "été"), (3, None), (4, ""), (12, (texts or ["x"])[0][50:199])]
    table = llm.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_passages(docs, table, block_bytes=block_bytes).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3])
    mine = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=key)
    assert mine == sorted(passages(rows, items), key=key)
    assert all(r.n_items == len(r["items"]) for r in got)


def test_spans_point_into_the_original(llm, tricky):
    table = llm.createDataFrame([(1, "été12 ... 日本語5")], "item_id long, text string")
    doc = llm.createDataFrame([(1, "«Été» É\U0001f600 -- été12,\n日本語5!")], "doc_id long, text string")
    row = decontamination.find_passages(doc, table, carry=True).first()
    assert [row.row.text[s.first : s.last] for s in row.spans] == ["été12,\n日本語5"]


def test_groups(docs):
    same(jaccard_trie.near_duplicates(docs).collect(), list(groups(rows_of(docs))))


def test_cut_tries_lose_no_link(docs, monkeypatch):
    import moonstride.llm.jaccard_trie as module

    pairs = [(np.sort(np.random.RandomState(s).choice(3000, 40, False)).astype(np.uint64)) for s in range(30)]
    pairs += [np.sort(np.append(p[:-1], np.uint64(5000 + k))) for k, p in enumerate(pairs)]
    found = module.trie_links(list(range(60)), np.full(60, 40), pairs)
    assert {(min(a, b), max(a, b)) for a, b in found} == {(k, k + 30) for k in range(30)}


def test_katz(docs):
    rows = rows_of(docs)
    train = [crc(i, 5) != 1 for i, _ in rows]
    learn = F.coalesce(F.pmod(crc_of_id(), F.lit(5)) != 1, F.lit(True))
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz_model.score_texts(docs, learn).collect()]
    if not rows:
        assert got == []
        return
    _, words, _, _ = katz(rows, train, np.ones(6), np.full(6, 0.5))
    having = lambda c: np.array([0, *(sum(v == r for v in c.values()) for r in range(1, 7))], float)
    pairs = {}
    for (i, text), learned in zip(rows, train):
        if learned:
            tokens = [*__import__("brute").WORD.findall(low(text)), None]
            for pair in zip(["<start>", *tokens], tokens):
                pairs[pair] = pairs.get(pair, 0) + 1
    kept_words = katz_model.Discount.good_turing(having(words)).kept
    kept_pairs = katz_model.Discount.good_turing(having(pairs)).kept
    want, words, two, after = katz(rows, train, kept_words, kept_pairs)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[5])
    for mine, theirs in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert mine[:4] == theirs[:4]
        assert mine[4:] == pytest.approx(theirs[4:], abs=1e-6)
    for history in list(after)[:3]:
        assert sum(two(history, w) for w in [*words, "<unknown>"]) == pytest.approx(1)


def test_languages_held_out(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.pmod(crc_of_id(), F.lit(4)) == 2
    model = language_codes.fit(docs.where(~held_out), per_language=100)
    found = language_codes.identify(docs.where(held_out), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()
    assert found.where("score < 0 or score > 1").count() == 0


def test_languages_of_tricky_rows(tricky, nothing):
    model = language_codes.fit(tricky)
    assert model.languages == ["en", "fr"]
    for row in language_codes.identify(tricky, model, carry=True).collect():
        lettered = any(c.isalpha() for c in row.row.text or "")
        assert (row.lang_pred in model.languages) == lettered and 0 <= row.score <= 1
    empty = language_codes.fit(nothing)
    assert {r.lang_pred for r in language_codes.identify(tricky, empty).collect()} == {"und"}
    assert language_codes.identify(nothing, model).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language_codes.codewords(n)
    assert len({tuple(c) for c in code.tolist()}) == n
    bits = code.shape[1]
    apart = [(bits - int(a @ b)) // 2 for k, a in enumerate(code) for b in code[:k]]
    assert n < 4 or min(apart) >= 3
