"""Words that defeat sums of powers modulo 2^64."""

import numpy as np

from moonstride.llm import jaccard_trie, quality_ledger, substring_dedup
from moonstride.llm.columns import utf8
from moonstride.llm.word_hashes import words_of


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def pair(n):
    word = thue_morse(n)
    return word, word.translate(str.maketrans("ab", "ba"))


def test_hashes_differ():
    import pyarrow as pa

    for n in (64, 512, 1024, 4096):
        for second in (False, True):
            found = words_of(*utf8(pa.array([" ".join(pair(n))]))).hashes(second=second)
            assert len(np.unique(found)) == 2


def test_two_documents_that_differ_in_one_such_word(llm):
    rest = " ".join(f"w{i}" for i in range(34))
    docs = llm.createDataFrame([(i, f"{word} {rest}") for i, word in enumerate(pair(1024))], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(docs).collect()] == [0, 0]
    few = llm.createDataFrame([(i, f"{word} x y z") for i, word in enumerate(pair(1024))], "doc_id long, text string")
    assert sorted(r.component_id for r in jaccard_trie.near_duplicates(few).collect()) == [0, 1]


def test_a_policy_filters_stored_bits(llm, tricky):
    ledger = quality_ledger.build_ledger(tricky)
    kept = quality_ledger.apply_policy(ledger, quality_ledger.PROSE).where("kept")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "split" not in plan and "lambda" not in plan
