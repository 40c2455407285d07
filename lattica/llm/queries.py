"""The thin queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lattica.llm import alignment, decontaminate, divergence, language, licenses, linedup, mixing, neardup, packing, sharding, toxicity, url_index, vectors
from lattica.llm.common import table
from lattica.llm.oracles import SQL

__all__ = ["QUERIES", "SQL"]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.marked(rows, table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_plan(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_index.judged(spark, table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_report(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_sharding": op3_sharding,
    "op4_packing": op4_packing,
    "op5_minhash": op5_minhash,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_embeddings": op8_embeddings,
    "op9_mixing": op9_mixing,
    "op10_url_filter": op10_url_filter,
    "op11_line_dedup": op11_line_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_source_divergence": op13_source_divergence,
}
