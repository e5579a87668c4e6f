"""Helpers shared by the corpus operators: tables in the shared checkpoint
folder, joins against small key sets, connected components and a distributed
row number.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.session import ensure_checkpoint_dir

SCRATCH_FOLDER = "gamestats-llm"
# A key set up to this size (rows x 64 bytes, an upper bound for the rows used
# here) is broadcast to a join; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word is a run of bytes other than space and the controls 09-0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the session's Python workers (once per application),
    for sessions whose executors don't have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="gamestats-"), "gamestats.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{SCRATCH_FOLDER}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: the plan is cut, later stages survive lost executors by rereading,
    and the statistics of the result are known to the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_keys(df: DataFrame, keys: DataFrame, on: list[str], how: str = "leftsemi") -> DataFrame:
    """Join against a written key table.  Its row count decides the strategy,
    never the result: up to ``BROADCAST_ROWS`` rows the keys are broadcast and
    ``df`` isn't shuffled; beyond, both sides are shuffled."""
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)


def _digest(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("v", "m")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph given as ``(a, b)`` rows:
    ``(node, component)`` for every node with an edge to another one, where
    ``component`` is the smallest node reachable.

    Alternating large-star and small-star rounds.  The minimum of a
    neighbourhood is a partial + final aggregation, and a hub's neighbours
    reach it through a join that adaptive execution can split, so no task
    holds a whole neighbourhood.  Every round is written to the shared folder.
    """
    e = edges.where(F.col("a") != F.col("b"))
    e = e.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct()
    e = materialize(e, name)
    seen = _digest(e)
    if seen[0] == 0:
        return e.select(F.col("v").alias("node"), F.col("m").alias("component"))
    while True:
        # large star: every larger neighbour of u is tied to u's smallest neighbour
        both = e.select(F.col("v").alias("u"), F.col("m").alias("w")).union(
            e.select(F.col("m").alias("u"), F.col("v").alias("w")))
        low = both.groupBy("u").agg(F.min("w").alias("low"))
        low = low.select("u", F.least("u", "low").alias("low"))
        large = (both.where(F.col("w") > F.col("u")).join(low, "u")
                 .select(F.col("w").alias("v"), F.col("low").alias("m"))
                 .where(F.col("v") != F.col("m")).distinct())
        # small star: u's smaller neighbours and u are tied to the smallest of them
        least = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(least, "v")
        tied = small.where(F.col("m") != F.col("low")).select(
            F.col("m").alias("v"), F.col("low").alias("m"))
        e = materialize(tied.union(least.select("v", F.col("low").alias("m"))).distinct(), name)
        now = _digest(e)
        if now == seen:
            return e.select(F.col("v").alias("node"), F.col("m").alias("component"))
        seen = now


def with_global_rank(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """0-based position of each row of a written table in a total order.

    The rows are range-partitioned and sorted; each partition's row count
    (one row per partition) gives its offset.  No task sees all rows.
    """
    parts = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_id", F.monotonically_increasing_id()), "ranked")
    # the upper bits of the id are the partition, the lower 33 the place in it
    split = parts.withColumn("_part", F.shiftright("_id", 33))
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect()  # one row a partition
    offsets, before = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["_n"]
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    return (split.join(F.broadcast(starts), "_part")
            .withColumn(rank, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_id", "_part", "_before"))
