"""From raw documents to token ids: five stages, each on what the one before kept.

Every stage takes (spark, docs, folder of the tables). All but the last return the columns of
``docs``; what a stage decides takes effect on its rows or texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moonstride.llm import bpe_automaton, decontamination, jaccard_trie, language_codes, line_runs
from moonstride.llm.columns import crc_of_id
from moonstride.llm.queries import TOKENIZER
from moonstride.llm.shipping import ship_library
from moonstride.session import stage
from moonstride.sources.tables import read_table

# a text whose best language has a smaller share, and no clear lead, is rejected
LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language can be told; learned from three quarters of the labelled ones.

    Texts that are null or have no letter go, and those between two languages with less than
    ``LEAST_SHARE`` for the better one. If no document is labelled, only texts without a letter go.
    """
    ship_library(spark)
    held_out = F.coalesce(F.pmod(crc_of_id(), F.lit(4)) == 2, F.lit(False))
    model = language_codes.fit(docs.where(~held_out))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_codes.identify(docs, model, carry=True)
    doubtful = F.col("ambiguous") & (F.col("score") < LEAST_SHARE)
    return found.where((F.col("lang_pred") != language_codes.UNDETERMINED) & ~doubtful).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the lines they share with documents of higher ids; ``n_chars`` follows the text."""
    ship_library(spark)
    found = line_runs.drop_shared_lines(docs, carry=True)
    changed = F.col("n_dropped") > 0
    fields = {f.name: f.dataType for f in docs.schema.fields}
    out = []
    for name in docs.columns:
        old = F.col("row").getField(name)
        new = {"text": F.col("kept"), "n_chars": F.char_length("kept")}.get(name)
        out.append((old if new is None else F.when(changed, new.cast(fields[name])).otherwise(old)).alias(name))
    return found.select(*out)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates; rows without id stay."""
    ship_library(spark)
    groups = jaccard_trie.near_duplicates(docs)
    copies = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_id_of_copy")).distinct()
    return docs.join(copies, docs["doc_id"] == F.col("_id_of_copy"), "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    ship_library(spark)
    found = decontamination.find_passages(docs, read_table(spark, folder, "benchmark"), carry=True)
    return found.where(~F.col("contaminated")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    ship_library(spark)
    return bpe_automaton.encode_and_decode(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

# SQL cannot express the language model, the linking of groups or the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = read_table(spark, folder, "documents")
    for place, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, folder)
        if place < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
