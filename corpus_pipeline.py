"""A corpus pipeline: ``documents`` from raw rows to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet into the shared checkpoint folder and gives the reread
table to the next stage.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.llm.common import join_keys, materialize, read_table
from gamestats.llm.langid import keep_identified
from gamestats.llm.line_dedup import line_dedup
from gamestats.llm.minhash import near_dedup
from gamestats.llm.mixing import mix
from gamestats.llm.packing import best_fit_packing


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or letters go."""
    return keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines.  A document of which no visible line is
    left goes; one that had none stays."""
    # the document's own columns may be named like the operator's counts
    own = {c: f"_{k}_{c}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    cut = line_dedup(docs.withColumnsRenamed(own))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    kept = cut.where(~F.coalesce(emptied, F.lit(False)))
    return kept.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    dropped = near_dedup(docs).where(~F.col("kept")).select("doc_id").distinct()
    return join_keys(docs, materialize(dropped, "dropped"), ["doc_id"], "leftanti").select(
        *docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.  Rows that repeat in all
    columns share their copies."""
    tag = F.xxhash64(*[F.col(c) for c in docs.columns])
    key = F.coalesce("doc_id", F.lit(-1)).alias("_id")
    taken = materialize(
        mix(docs).groupBy(key, F.col("doc_id").isNull().alias("_none"), F.col("tag").alias("_tag"))
        .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_copies") > 0), "copies")
    marked = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), key,
                         F.col("doc_id").isNull().alias("_none"), tag.alias("_tag"))
    found = join_keys(marked, taken, ["_id", "_none", "_tag"], "inner")
    single = found.where(F.col("_rows") == 1)
    repeated = found.where(F.col("_rows") > 1).dropDuplicates(["_id", "_none", "_tag"])
    out = single.union(repeated).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies").cast("long"))))
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return best_fit_packing(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("mix_sources", mixture),
    ("pack", pack),
]

# Language identification is a trained network: SQL cannot express run().
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
