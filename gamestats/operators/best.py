"""Per-group summaries of rated items (A6, A7, J2-J5): mean, maximum, and the
merged names of all items or of the best-rated ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamestats.operators.exact import exact_stats

# The separator between merged names, and the item type and the
# missing-name marker of the ratings filter.
NAME_SEPARATOR = " | "
SERIES_TYPE = "TV_SERIES"
MISSING_NAME = "null"


def rated_items(df: DataFrame, item_type: str = SERIES_TYPE, type_col: str = "type",
                name_col: str = "episode") -> DataFrame:
    """items of one type that have a name (neither NULL nor the text
    ``'null'``).  A plain filter; on Parquet it is pushed into the scan."""
    name = F.col(name_col)
    return df.where((F.col(type_col) == F.lit(item_type)) & name.isNotNull()
                    & (name != F.lit(MISSING_NAME)))


def merged(name: str | Column, sep: str = NAME_SEPARATOR) -> Column:
    """A7: all non-NULL names of the group joined by ``sep``, in name order
    (the reference's order depends on the shuffle; sorting makes it stable)."""
    name = F.col(name) if isinstance(name, str) else name
    return F.array_join(F.array_sort(F.collect_list(name)), sep)


def summarise_group(df: DataFrame, key: str, rating: str) -> DataFrame:
    """A1 + A6: mean and maximum rating per group.  The mean is that of the
    exact sum (see ``gamestats.operators.exact``): it has all its digits and
    doesn't depend on how the rows are dealt to tasks."""
    return exact_stats(df, key, rating, mean="avg_rating", largest={"max_rating": rating}).select(
        key, "avg_rating", "max_rating")


def _with_summary(named: DataFrame, summary: DataFrame, key: str, column: str) -> DataFrame:
    joined = named.withColumnRenamed(key, "_group").join(
        summary, F.col("_group").eqNullSafe(F.col(key)), "inner")
    return joined.select(key, column, "max_rating", "avg_rating")


def all_names(df: DataFrame, key: str, rating: str, name: str,
              summary: DataFrame | None = None) -> DataFrame:
    """The reference's result as it runs (J2-J4): per group, every item name
    merged into one text, with the maximum and the mean (``summary``, if they
    are already there).

    The merged text holds every name of the group, so one task holds the group
    by definition; ``gamestats.operators.merge.name_chunks`` gives the same text
    in fixed-size chunks for groups that are too large for that.
    """
    names = df.groupBy(key).agg(merged(name).alias("names"))
    return _with_summary(names, summarise_group(df, key, rating) if summary is None else summary,
                         key, "names")


def best_names(df: DataFrame, key: str, rating: str, name: str,
               summary: DataFrame | None = None) -> DataFrame:
    """J5 + A7: per group, the names of the items whose rating equals the
    group's maximum (all of them when tied), with the maximum and the mean
    (``summary``, if they are already there: the detail is then read once).

    The best items are picked by rank.  Each task ranks the rows it has and
    drops all but the best of each group before the shuffle, so losers are never
    shuffled, and the merge needs no further one.  The ties of a group meet in
    one task, as their text does; ``gamestats.operators.merge.best_items`` and
    ``name_chunks`` keep those of a hot group apart.  A NULL key is a group like
    any other; a group without any rating has no best item and no row.
    """
    by_rating = Window.partitionBy(key).orderBy(F.col(rating).desc())
    best = (df.where(F.col(rating).isNotNull()).select(key, rating, name)
            .withColumn("_rank", F.rank().over(by_rating)).where(F.col("_rank") == 1))
    names = best.groupBy(key).agg(merged(name).alias("best_names"))
    return _with_summary(names, summarise_group(df, key, rating) if summary is None else summary,
                         key, "best_names")
