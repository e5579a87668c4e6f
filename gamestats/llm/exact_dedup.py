"""Exact deduplication through an extendible-hash index on shared files.

Every text is normalised (A-Z lower-cased) and addressed by a 64-bit key.  The
keys are kept in buckets of bounded size: a directory of ``2^depth`` slots maps
the leading bits of a key to its bucket; while a bucket is overfull the
directory doubles and that bucket is split by one more bit.  The index is
written to the shared checkpoint folder, sorted by bucket and key.

The texts of keys with several documents are dealt by ranges of (bucket, key) to
owner tasks.  An owner chains the different texts of a key, comparing them byte
for byte, and each link of a chain gives its documents' ``keep_id`` and
``group_size``.

Copies are combined before they are dealt, into at most ``PARTS`` rows a text,
so a text that fills a third of the table doesn't fill its owner.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamestats.llm.common import ascii_lower, join_keys, materialize

KEY_BITS = 64
BUCKET_KEYS = 8192  # capacity of a bucket, in distinct keys
ADDRESS = ["key", "n_bytes", "digest"]
PARTS = 16          # rows, at most, that the copies of a text are combined into


def default_key(norm: Column) -> Column:
    return F.xxhash64(norm)


def _leading(key: Column, bits: int) -> Column:
    """The leading ``bits`` bits of a 64-bit key as a number."""
    return F.lit(0).cast("long") if bits == 0 else F.shiftrightunsigned(key, KEY_BITS - bits)


def build_directory(keys: DataFrame, capacity: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The directory over distinct ``key`` values: ``(slot, bucket, depth)`` rows
    and the global depth.  ``bucket`` is the first slot of the bucket.

    It starts at the depth that would hold the keys if they were spread
    evenly, less one; then, while a bucket is overfull, the directory doubles
    and the overfull buckets are split.
    """
    n = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / capacity)) - 1)
    counts = keys.groupBy(_leading(F.col("key"), depth).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"))
    level = materialize(counts, "bucket-level")
    closed: list[tuple[int, DataFrame]] = []
    while depth < KEY_BITS - 1 and not level.where(F.col("n") > capacity).isEmpty():
        closed.append((depth, level.where(F.col("n") <= capacity)))
        over = level.where(F.col("n") > capacity).select(F.col("prefix").alias("parent"))
        split = keys.withColumn("parent", _leading(F.col("key"), depth)).join(over, "parent", "leftsemi")
        depth += 1
        level = materialize(
            split.groupBy(_leading(F.col("key"), depth).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n")), "bucket-level")
    closed.append((depth, level))
    directory = None
    for d, buckets in closed:
        wide = depth - d
        slots = buckets.select(
            F.shiftleft("prefix", wide).alias("bucket"), F.lit(d).alias("depth"),
            F.explode(F.sequence(F.shiftleft("prefix", wide),
                                 F.shiftleft(F.col("prefix") + 1, wide) - 1)).alias("slot"))
        directory = slots if directory is None else directory.union(slots)
    return directory, depth


def build_index(entries: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """The index: one row per address ``(key, n_bytes, digest)`` with the
    number ``n`` of its documents, filed under its bucket."""
    links = materialize(entries.groupBy(*ADDRESS).agg(F.count(F.lit(1)).alias("n")), "links")
    directory, depth = build_directory(links.select("key").distinct(), capacity)
    filed = (links.withColumn("slot", _leading(F.col("key"), depth))
             .join(directory, "slot").drop("slot"))
    return materialize(filed.repartitionByRange("bucket", "key")
                       .sortWithinPartitions("bucket", "key"), "index")


def own_chains(copies: DataFrame) -> DataFrame:
    """The chains of the buckets: ``copies`` (``bucket``, address, ``norm``,
    ``keep_id``, ``group_size``; several rows a text) are dealt by ranges of
    (bucket, key), and what follows happens in the owner of a range, without
    another shuffle.  A row per link: a text of a key, ``chain`` its number
    among them, ``texts`` the number of texts at its address."""
    link = ["bucket", *ADDRESS, "norm"]
    owned = copies.repartitionByRange("bucket", "key")
    links = owned.groupBy(*link).agg(F.max("keep_id").alias("keep_id"),
                                     F.sum("group_size").alias("group_size"))
    chain = Window.partitionBy("bucket", "key").orderBy("n_bytes", "digest", "norm")
    return (links.withColumn("chain", F.row_number().over(chain))
            .withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("bucket", *ADDRESS))))


def exact_dedup(docs: DataFrame, key=default_key, digest=None,
                capacity: int = BUCKET_KEYS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` per row of ``docs``
    (columns ``doc_id`` and ``text``; other columns are ignored).

    * A null text counts as the empty text.
    * Texts are equal when identical after lower-casing A-Z.
    * The row with the largest ``doc_id`` of a group stays; null ids are
      smaller than all others.  ``kept`` is ``doc_id = keep_id``, so rows that
      repeat that id with an equal text are all marked kept; in a group of
      null ids only, ``keep_id`` is null and its rows are kept.
    * An empty table gives an empty result.

    ``key`` and ``digest`` can be replaced by weaker hashes; the result stays
    the same because texts are compared in full wherever both agree.
    """
    norm = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    digest = digest or (lambda t: F.unhex(F.sha2(t, 256)))
    base = (docs.select(F.col("doc_id"), norm.alias("norm"))
            .withColumn("key", key(F.col("norm")))
            .withColumn("n_bytes", F.octet_length("norm"))
            .withColumn("digest", digest(F.col("norm"))))
    sha = F.sha2(F.col("norm"), 256).alias("text_sha256")
    entries = materialize(base.select("doc_id", *ADDRESS, sha), "entries")
    index = build_index(entries, capacity)
    shared = materialize(index.where(F.col("n") > 1).select("bucket", *ADDRESS), "shared-links")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).alias("part")
    copies = (join_keys(base, shared, ADDRESS, "inner")
              .groupBy("bucket", *ADDRESS, "norm", part)
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # a text is kept only where others share its whole address
    chains = materialize(own_chains(copies).withColumn(
        "norm", F.when(F.col("texts") > 1, F.col("norm"))), "chains")
    groups = chains.where(F.col("texts") == 1).select(*ADDRESS, "keep_id", "group_size")
    collided = chains.where(F.col("texts") > 1).select(*ADDRESS, "norm", "keep_id", "group_size")

    found = entries.join(groups, ADDRESS, "left")
    if not collided.isEmpty():  # different texts share a whole address: told apart by text
        addresses = materialize(collided.select(*ADDRESS).distinct(), "collided")
        some = join_keys(base, addresses, ADDRESS).withColumn("text_sha256", sha)
        apart = some.join(collided, [*ADDRESS, "norm"]).drop("norm")
        found = join_keys(found, addresses, ADDRESS, "leftanti").unionByName(apart)
    single = F.col("group_size").isNull()
    out = found.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "text_sha256")
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
