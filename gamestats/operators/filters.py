"""Row filters on games (F2).  Plain predicates: Catalyst pushes them below
projections and, on Parquet, into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_result(games: DataFrame, result: str, column: str = "result") -> DataFrame:
    """Games that ended with ``result`` (e.g. ``'1-0'`` for white wins)."""
    return games.where(F.col(column) == F.lit(result))
