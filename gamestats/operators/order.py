"""Total orders without a single task (O1, O2, R2): ranges, then positions.

The rows are dealt to parts by ranges of the sort key (bounds from a sample, so
the parts are about even) and sorted inside each; parts follow each other in
the order of their file names.  A row's position is the number of rows in the
parts before its own plus its index in its file: one small row per part comes
to the driver, and no task sees more than its part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.sources.scratch import written


def key_order(keys: str | Sequence[str], descending: bool = False) -> list[Column]:
    """Sort columns for keys, NULL last either way."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return [F.col(k).desc_nulls_last() if descending else F.col(k).asc_nulls_last() for k in keys]


def in_ranges(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """``df`` in parts that follow each other in ``order``.  Rows with equal keys
    may be dealt to several parts: a hot key doesn't make one part large."""
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    by = [*order, F.col("_spread")]
    ranges = spread.repartitionByRange(parts, *by) if parts else spread.repartitionByRange(*by)
    return ranges.sortWithinPartitions(*by).drop("_spread")


def part_rows(table: DataFrame) -> list[tuple[str, int, int]]:
    """File, first position and number of rows of each part of a written table."""
    counts = (table.select(F.col("_metadata.file_name").alias("file")).groupBy("file")
              .agg(F.count(F.lit(1)).alias("n")).collect())
    out, before = [], 0
    for r in sorted(counts, key=lambda r: r["file"]):
        out.append((r["file"], before, r["n"]))
        before += r["n"]
    return out


def with_positions(table: DataFrame, parts: Sequence[tuple[str, int]], name: str) -> DataFrame:
    """A Parquet table of sorted parts with every row's 1-based position."""
    starts = table.sparkSession.createDataFrame([(f, b) for f, b in parts], "_file string, _before long")
    rows = table.select(F.struct(*[F.col(c) for c in table.columns]).alias("_row"),
                        F.col("_metadata.file_name").alias("_file"),
                        F.col("_metadata.row_index").alias("_index"))
    placed = rows.join(F.broadcast(starts), "_file")        # one row per part
    return placed.select(*[F.col("_row")[c].alias(c) for c in table.columns if c != name],
                         (F.col("_before") + F.col("_index") + 1).alias(name))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with the 1-based position of every row in ``order``, the columns
    that aren't in it deciding among ties (rows equal in all columns take their
    positions in any order).  A column called ``name`` is replaced."""
    ties = [F.col(c).asc_nulls_last() for c in df.columns]
    table = written(in_ranges(df, [*order, *ties]), "ranked")
    return with_positions(table, [(f, b) for f, b, _ in part_rows(table)], name)
