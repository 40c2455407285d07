"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lattica.llm import decontaminate, language, mixing, neardup, packing
from lattica.llm.common import dropped, settled, table
from lattica.session import ship


#: Languages to keep (None: all that the labelled documents teach), and the score from which a prediction is trusted: the
#: language is likelier than all others together.
LANGUAGES, LEAST_SCORE = None, 0.5


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages to keep, as far as can be told. The others are rejected: texts without a
    letter, unlike every language learned, or that may as well be in another one."""
    return language.accepted(docs, LANGUAGES, LEAST_SCORE)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the least doc_id."""
    return neardup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def at_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.packed(docs)


def shipped(stage):
    """The stage, with the package at hand on all workers."""
    return lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir)


STAGES = [
    ("language", shipped(by_language)),
    ("near_duplicates", shipped(without_near_copies)),
    ("decontamination", shipped(without_benchmark)),
    ("mixing", shipped(at_target_weights)),
    ("packing", shipped(as_tokens)),
]

#: SQL can't express learned prototypes, the tokenizer and the packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. A stage's own tables, and the table it has read, are deleted once its rows are written;
    the last stage reads its table when the result is asked for."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
        dropped(last)
    return STAGES[-1][1](spark, docs, sf_dir)
