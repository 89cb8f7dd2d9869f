"""A corpus pipeline of five stages over the documents of a folder.

Toxic documents go, one document of each group of near copies stays, benchmark passages are cut out, sources are mixed to
target weights, and what is left becomes token ids in a content-addressed store.

Every stage takes rows with null values in any column, empty and very long texts, repeated rows and ids, and columns of any
other name, and passes them on unless it decides against a text; an empty table stays empty. Each stage says what it does with
nulls and repeats.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from mergewell.llm import mixing, ngram_join, suffix_automaton, token_store, toxicity
from mergewell.llm.store import Store, read_table
from pyspark.sql import DataFrame, SparkSession

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the folder's labels and drops documents that score as toxic. Null and empty texts score as the labels'
    share does; rows with equal texts stay or go together; without labels nothing goes."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, that with the smallest id stays; if that id
    repeats, its row with the smallest text. Rows without words, or without an id, all stay."""
    return ngram_join.keep_one(docs, ngram_join.Measure(width=5, num=80, den=100))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out, and drops documents that are mostly such passages. Null texts stay null, and clean rows as
    they are; without a benchmark all do."""
    return suffix_automaton.remove_items(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics come near to their target weights. A null source or language is
    a value of its own; rows that share an id, null ones too, are sampled together."""
    return mixing.mixed(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token ids, and returns each document's place in them as read back. Null texts are empty and have the end id only;
    null ids come first; rows that repeat are written each."""
    return token_store.store_round_trip(docs, token_store.Format(TOKENIZER, added=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near_copies", remove_near_copies),
    ("benchmark", remove_benchmark),
    ("mixing", mix_sources),
    ("tokens", store_tokens),
]

#: SQL can't express the first stage, which trains a model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's result is written and read again."""
    store = Store(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = store.write(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            store.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs
