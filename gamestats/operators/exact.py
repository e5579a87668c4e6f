"""Sums and means of real values that don't depend on the order of addition
(A1 on measured values).

Two aggregations, both partial + final: per key and bin the units are summed as
integers, then the few bins of a key are joined.  A hot key reaches either
shuffle as one row per task and bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.functions.exact import UNIT_SUM, bin_of, total_of, units_of


def exact_stats(df: DataFrame, keys: str | Sequence[str], value: str, total: str = "total",
                mean: str = "mean", count: str = "n", largest: Mapping[str, str] | None = None) -> DataFrame:
    """Per key: the correctly rounded sum of a double column, that sum divided
    by the count, the count of values, and maxima (``{alias: column}``).

    Any partitioning and any order of the rows give the same bits.  NULL values
    don't count; a key without a value has sum and mean NULL.  A NaN, or both
    infinities, make the sum NaN; one infinity makes it that infinity; finite
    values that add up beyond the range give an infinity.  A NULL key is a key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tops = dict(largest or {})
    x = F.col("_value")
    rows = df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                     F.col(value).cast("double").alias("_value"),
                     *[F.col(c).alias(f"_top{i}") for i, c in enumerate(tops.values())])
    parts = [f"_key{i}" for i in range(len(keys))]

    def special(test: Column) -> Column:
        return F.coalesce(F.max(test), F.lit(False))

    binned = rows.groupBy(*parts, F.coalesce(bin_of(x), F.lit(0)).alias("_bin")).agg(
        F.sum(units_of(x).cast(UNIT_SUM)).alias("_units"), F.count(x).alias("_n"),
        special(F.isnan(x)).alias("_nan"), special(x == float("inf")).alias("_up"),
        special(x == float("-inf")).alias("_down"),
        *[F.max(f"_top{i}").alias(f"_top{i}") for i in range(len(tops))])
    bins = F.map_from_entries(F.collect_list(F.when(
        F.col("_units").isNotNull(), F.struct("_bin", "_units"))))
    joined = binned.groupBy(*parts).agg(
        total_of(bins).alias("_total"), F.sum("_n").alias("_n"), F.max("_nan").alias("_nan"),
        F.max("_up").alias("_up"), F.max("_down").alias("_down"),
        *[F.max(f"_top{i}").alias(f"_top{i}") for i in range(len(tops))])
    value_sum = (F.when(F.col("_nan") | (F.col("_up") & F.col("_down")), float("nan"))
                 .when(F.col("_up"), float("inf")).when(F.col("_down"), float("-inf"))
                 .otherwise(F.col("_total")))
    return joined.select(
        *[F.col(p).alias(k) for p, k in zip(parts, keys)],
        F.when(F.col("_n") > 0, value_sum).alias(total),
        F.when(F.col("_n") > 0, value_sum / F.col("_n")).alias(mean), F.col("_n").alias(count),
        *[F.col(f"_top{i}").alias(a) for i, a in enumerate(tops)])
