"""Intermediate tables in the shared checkpoint folder.

Writing one cuts the plan: what follows survives a lost executor by reading it
again, and two readers of it see the same rows in the same places.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from gamestats.session import ensure_checkpoint_dir

SCRATCH_FOLDER = "gamestats-scratch"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own, read back."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{SCRATCH_FOLDER}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
