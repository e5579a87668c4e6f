"""Merged names of groups of any size (A7, J3): fixed-size numbered chunks.

One text per group needs the whole group in one task.  Here the names of all
groups are put in order by ranges, each name gets its place in its group from
the sizes of the parts before it, and every ``size`` places are one chunk: a
series that holds a third of all rows ends in as many tasks as its chunks fill.
The chunks of a group, joined in order, are the group's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamestats.sources.scratch import written

CHUNK = 1000
SEPARATOR = " | "


def _placed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Each distinct name of each group (``g``, ``name``) with its copies and
    the 0-based place of the first of them in the group, in name order."""
    # repeated names become one row with a count, before anything is sorted
    counted = (df.where(F.col(name).isNotNull())
               .groupBy(F.struct(F.col(key).alias("key")).alias("g"), F.col(name).alias("name"))
               .agg(F.count(F.lit(1)).alias("copies")))
    parts = written(counted.repartitionByRange("g", "name").sortWithinPartitions("g", "name")
                    .withColumn("id", F.monotonically_increasing_id()), "names")
    # the upper bits of the id are the part, the lower 33 the place in it
    parts = parts.withColumn("part", F.shiftright("id", 33))
    sizes = parts.groupBy("g", "part").agg(F.sum("copies").alias("held"))
    # a group has at most one row per part here
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("g", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("g", "part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return parts.join(offsets, ["g", "part"]).select(
        "g", "name", "copies",
        (F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("place"))


def name_chunks(df: DataFrame, key: str, name: str, size: int = CHUNK,
                sep: str = SEPARATOR) -> DataFrame:
    """``(key, chunk, first_place, n_names, names)``: chunk ``c`` of a group
    holds its names at the places ``c * size`` to ``(c + 1) * size - 1`` in name
    order, repeated names as often as they occur, joined by ``sep``.

    NULL names are left out, so a group of nothing else has no row; a NULL key
    is a group.  No task holds more than a part of the sorted names or a chunk;
    a name that a third of all rows repeat is one row with a count until its
    copies are dealt to their chunks.
    """
    placed = _placed(df, key, name)
    last = F.col("place") + F.col("copies") - 1
    dealt = placed.withColumn("chunk", F.explode(F.sequence(
        F.floor(F.col("place") / size), F.floor(last / size))))
    start = F.greatest(F.col("place"), F.col("chunk") * size)
    end = F.least(last + 1, (F.col("chunk") + 1) * size)
    inside = dealt.select("g", "chunk", start.alias("at"), "name", (end - start).cast("int").alias("copies"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "name", "copies")))
    grouped = inside.groupBy("g", "chunk").agg(
        F.min("at").alias("first_place"), F.sum("copies").alias("n_names"), ordered.alias("held"))
    texts = F.flatten(F.transform("held", lambda x: F.array_repeat(x["name"], x["copies"])))
    return grouped.select(F.col("g.key").alias(key), "chunk", "first_place", "n_names",
                          F.array_join(texts, sep).alias("names"))


def chunk_index(chunks: DataFrame, key: str, sep: str = SEPARATOR) -> DataFrame:
    """One small row per group: names, chunks, and the length of the joined text."""
    gaps = (F.count(F.lit(1)) - 1) * len(sep)
    return chunks.groupBy(key).agg(F.sum("n_names").alias("n_names"), F.count(F.lit(1)).alias("n_chunks"),
                                   (F.sum(F.length("names")) + gaps).alias("n_chars"))


def best_items(df: DataFrame, key: str, rating: str, name: str, spread: int = 32) -> DataFrame:
    """J5 without a join on the detail: the rows ``(key, rating, name)`` whose
    rating is the largest of their group, all of them when tied.

    The input is read once.  Each task keeps the best rows it has seen of a
    group and drops the others before the shuffle; groups are dealt in
    ``spread`` shares by a hash of the name, so that the ties of a hot group
    don't meet in one task.  What is left is written, and only those of the
    shares that reach the group's maximum stay.  NULL ratings don't count; NaN
    is larger than any number.
    """
    rows = df.where(F.col(rating).isNotNull()).select(
        F.struct(F.col(key).alias("key")).alias("g"), F.col(rating).alias("rating"),
        F.col(name).alias("name"), F.pmod(F.xxhash64(name), F.lit(spread)).alias("share"))
    by_rating = Window.partitionBy("g", "share").orderBy(F.col("rating").desc())
    kept = written(rows.withColumn("rank", F.rank().over(by_rating)).where(F.col("rank") == 1)
                   .select("g", "rating", "name"), "best-items")
    top = kept.groupBy("g").agg(F.max("rating").alias("top"))
    best = kept.join(top, "g").where(F.col("rating") == F.col("top"))
    return best.select(F.col("g.key").alias(key), F.col("rating").alias(rating), F.col("name").alias(name))
