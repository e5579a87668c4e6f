"""Sorts, top-K and a repeatable sample (O1-O5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_by_key(df: DataFrame, keys: str | Sequence[str], descending: bool = False) -> DataFrame:
    """O1 / O2: total order on the key, NULL keys last."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(k).desc_nulls_last() if descending else F.col(k).asc_nulls_last()
             for k in keys]
    return df.orderBy(*order)


def top_k(df: DataFrame, value: str, k: int, tie_keys: str | Sequence[str]) -> DataFrame:
    """O3 + O4: the ``k`` rows with the largest ``value``; ties broken by the
    key ascending (NULL last), so the result is deterministic.

    Sort + limit plans as ``TakeOrderedAndProject``: each task keeps its own
    best ``k`` and only ``k`` rows per task reach the final merge.
    """
    tie_keys = [tie_keys] if isinstance(tie_keys, str) else list(tie_keys)
    order = [F.col(value).desc_nulls_last()] + [F.col(t).asc_nulls_last() for t in tie_keys]
    return df.orderBy(*order).limit(k)


def sample_k(df: DataFrame, key: str, k: int, seed: int = 1) -> DataFrame:
    """O5: ``k`` rows drawn without replacement, repeatable for a seed.

    Each row's rank is the MD5 of ``key || '#' || seed``: a pseudo-random order
    that does not depend on partitioning or task order and that any SQL engine
    can reproduce; ties (equal keys) are broken by the key.
    """
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    return df.orderBy(draw.asc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)
