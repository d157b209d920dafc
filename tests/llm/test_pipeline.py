"""The pipeline on the small tables and on tricky rows."""

import re

import corpus_pipeline
from brute import groups, passages, shared_lines
from pyspark.sql import functions as F

from moonstride.llm.queries import QUERIES, SQL
from moonstride.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    rows = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    for name, function in corpus_pipeline.STAGES:
        before = rows(docs) if name != "tokens" else None
        docs = stage(function(llm, docs, FOLDER), name)
        if name == "language":
            assert rows(docs) == [(i, t) for i, t in before if re.search(r"[^\W\d_]", t or "")]
        elif name == "lines":
            assert rows(docs) == sorted((i, kept) for i, _, _, kept in shared_lines(before))
            assert docs.where("n_chars <> char_length(text)").count() == 0
        elif name == "near_duplicates":
            assert rows(docs) == [(i, t) for (i, t), (_, _, first) in zip(before, groups(before)) if first == i]
        elif name == "benchmark":
            assert rows(docs) == [(i, t) for (i, t), found in zip(before, passages(before, items)) if not found[4]]
        if name != "tokens":
            assert docs.columns == columns
    assert docs.count() > 150
    whole = corpus_pipeline.run(llm, FOLDER)
    assert whole.exceptAll(docs).count() == 0 and docs.exceptAll(whole).count() == 0


def test_tricky_rows_pass_all_stages(llm, tricky, nothing):
    for docs in (tricky, nothing):
        columns = docs.columns
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(llm, docs, FOLDER), name)
            assert name == "tokens" or docs.columns == columns
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_nothing_labelled_rejects_only_texts_without_letters(llm, tricky):
    left = corpus_pipeline.language(llm, tricky.withColumn("lang", F.lit(None).cast("string")), FOLDER)
    assert left.count() == tricky.where(F.col("text").rlike(r"\p{L}")).count()


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
