"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moonstride.llm import (
    bisectors,
    bpe_automaton,
    conversation_repair,
    decontamination,
    jaccard_trie,
    katz,
    language_codes,
    line_runs,
    quality_ledger,
    sentence_pieces,
    substring_dedup,
    token_blocks,
    warc,
)
from moonstride.llm.columns import crc_of_id
from moonstride.llm.oracles import SQL
from moonstride.llm.shipping import ship_library
from moonstride.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_library(spark)
        return function(spark, folder)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return run


@query
def op1_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents through block files."""
    return token_blocks.tokens_through_files(read_table(spark, folder, "documents"), TOKENIZER, END_ID)


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents outside repeated windows of 35."""
    return substring_dedup.remove_repeats(read_table(spark, folder, "documents"))


@query
def op3_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded by the automaton."""
    return bpe_automaton.encode_and_decode(read_table(spark, folder, "documents"), TOKENIZER)


@query
def op4_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, base verdict and the prose policy's verdict for all documents."""
    ledger = quality_ledger.build_ledger(read_table(spark, folder, "documents"))
    judged = quality_ledger.apply_policy(ledger, quality_ledger.PROSE)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_ledger.fails(quality_ledger.BASE).alias("base_failed"), "kept", "failures",
    )


@query
def op5_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines they share with higher ids."""
    found = line_runs.drop_shared_lines(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages through WARC archives, equal payloads stored once."""
    return warc.pages_through_archives(read_table(spark, folder, "pages"))


@query
def op7_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents."""
    found = decontamination.find_passages(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    items = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated")


@query
def op8_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored by the bigram model of four fifths of them."""
    training = F.pmod(crc_of_id(), F.lit(5)) != 1
    found = katz.score_texts(read_table(spark, folder, "documents"), F.coalesce(training, F.lit(True)))
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned from three quarters of them."""
    docs = read_table(spark, folder, "documents")
    held_out = F.coalesce(F.pmod(crc_of_id(), F.lit(4)) == 2, F.lit(False))
    found = language_codes.identify(docs, language_codes.fit(docs.where(~held_out)))
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "second", "ambiguous")


@query
def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near duplicates among all documents."""
    return jaccard_trie.near_duplicates(read_table(spark, folder, "documents"))


@query
def op11_survivor_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    damaged = conversation_repair.damage(read_table(spark, folder, "conversations"))
    return conversation_repair.repair(damaged, damaged=True)


@query
def op12_bisector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings in eight clusters after ten rounds."""
    found = bisectors.cluster(read_table(spark, folder, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query
def op13_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded by backtracking over pieces."""
    return sentence_pieces.encode_and_decode(read_table(spark, folder, "documents"), PIECES)
