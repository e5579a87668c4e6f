"""Registered queries of the corpus operators: ``opN_<name>`` applies operator
N with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.llm import sql
from gamestats.llm.common import read_table
from gamestats.llm.covertree import top_k_search
from gamestats.llm.exact_dedup import exact_dedup
from gamestats.llm.fill_middle import fill_in_middle_digest
from gamestats.llm.langid import identify
from gamestats.llm.line_dedup import line_dedup
from gamestats.llm.minhash import near_dedup
from gamestats.llm.mixing import mix
from gamestats.llm.packing import best_fit_packing
from gamestats.llm.secrets import secret_digest
from gamestats.llm.suffix_dedup import suffix_dedup
from gamestats.llm.toxicity import toxicity
from gamestats.llm.warc import round_trip
from gamestats.llm.whitening import whiten


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed``, ``n_near`` and the SHA-256 of the
    remaining text (null: empty)."""
    return line_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_near",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages")).drop("target_uri")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_search(read_table(spark, sf_dir, "embeddings"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(read_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"),
                    read_table(spark, sf_dir, "labels")).drop("hits")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_suffix_dedup, op3_minhash_near_dedup, op4_language_id,
        op5_secret_scan, op6_warc, op7_mix_sources, op8_top_k_search, op9_exact_dedup,
        op10_best_fit_packing, op11_embedding_whitening,
        op12_toxicity, op13_fill_in_middle)
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": sql.line_dedup(),
    "op5_secret_scan": sql.secret_scan(),
    "op6_warc": sql.WARC,
    "op8_top_k_search": sql.TOP_K,
    "op9_exact_dedup": sql.EXACT_DEDUP,
    "op13_fill_in_middle": sql.FILL_MIDDLE,
}
