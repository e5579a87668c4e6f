"""Near-duplicate documents with circulant MinHash.

Two permutations give every signature coordinate: shingle fingerprints are
placed in a universe of ``UNIVERSE`` cells and shuffled by the first
permutation; coordinate ``k`` is the smallest value of the second permutation,
shifted circularly by ``k`` cells, over the cells of the set.  The values of
all coordinates for one cell are adjacent entries of the second permutation,
so a whole signature row is one contiguous read.

``BANDS`` bands of ``ROWS`` coordinates make the candidate buckets: two sets
with a similarity of 0.75 share no bucket with a probability of 5e-6.  Every
candidate pair that can decide a component is confirmed on the full sets.

Large groups: documents with equal sets are one node (combined before the
shuffle).  A pair's intersection is no larger than the number of shingles that
each of its documents shares with any other candidate; documents and pairs that
cannot reach the threshold by that count are left out, which takes away the
distant copies of a text that share its buckets.  Within a bucket, members are
first compared with one pivot; buckets whose members then lie in one component
are finished.  After at most ``PIVOT_ROUNDS`` pivots (fewer, once a pivot
finishes hardly any bucket), the members of what is left are compared across
components, so no link that joins two components is lost and a group of near
copies costs one comparison per member instead of all pairs.

That last step is the one that many far copies in the bucket of a large group
make expensive.  A tighter bound holds it down: the shingles are dealt to
``BLOCKS`` blocks by their fingerprint, and the intersection is no larger than
the sum over the blocks of the smaller of the two counts.  Copies that changed
different places of a text differ in different blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import components, join_keys, materialize, ship_package
from gamestats.llm.shingles import mix, shingle_sets, slices

THRESHOLD = 75           # per cent: 100 * intersection >= 75 * union
BANDS, ROWS = 32, 4
UNIVERSE = 1 << 20
PIVOT_ROUNDS = 3
LEAST_FINISHED = 0.1     # share of the members that a pivot must finish to have another
BLOCKS = 64
_CELLS_AT_ONCE = 1 << 13
SLICE_BYTES = 1 << 19      # text shingled at once; the tables for it take 16 times as much

FEATURES = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
SETS = "doc_id long, s1 long, shingles array<long>"
COUNTS = "d long, s long, blocks array<short>"
_U = np.uint64


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First permutation; windows of the second, wrapped around; band factors."""
    rng = np.random.default_rng(7)
    sigma = rng.permutation(UNIVERSE).astype(np.int64)
    pi = rng.permutation(UNIVERSE).astype(np.uint32)
    k = BANDS * ROWS
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:k - 1]]), k)
    return sigma, windows, rng.integers(1, 2 ** 64, ROWS, dtype=_U) | _U(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` circulant MinHash coordinates of a non-empty set."""
    sigma, windows, _ = _permutations()
    cells = sigma[(shingles & _U(UNIVERSE - 1)).astype(np.int64)]
    best = None
    for i in range(0, len(cells), _CELLS_AT_ONCE):
        low = windows[cells[i:i + _CELLS_AT_ONCE]].min(axis=0)
        best = low if best is None else np.minimum(best, low)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    factors = _permutations()[2]
    rows = (sig.astype(_U).reshape(BANDS, ROWS) + _U(1)) * factors
    return mix(rows.sum(axis=1, dtype=_U) * _U(BANDS) + np.arange(BANDS, dtype=_U)).view(np.int64)


def _set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    a = mix(shingles + _U(0x9E3779B97F4A7C15)).sum(dtype=_U)
    b = np.bitwise_xor.reduce(mix(shingles * _U(0xD6E8FEB86659FD93)), initial=_U(0))
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = batch.column(1)
        rows = ((i, (texts[k].as_py() or "").encode()) for k, i in enumerate(ids))
        for part in slices(rows, SLICE_BYTES):
            yield [r[0] for r in part], shingle_sets([r[1] for r in part])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _batches(batches):
        hashes = [_set_hash(s) for s in sets]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([h[0] for h in hashes], pa.int64()),
            pa.array([h[1] for h in hashes], pa.int64()),
            pa.array([band_keys(signature(s)) if len(s) else None for s in sets],
                     pa.list_(pa.int64())),
        ], names=["doc_id", "n_shingles", "s1", "s2", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _batches(batches):
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()),
            pa.array([_set_hash(s)[0] for s in sets], pa.int64()),
            pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
        ], names=["doc_id", "s1", "shingles"])


def _block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles per block that a node shares with any other (``own`` are the
    ones that it doesn't)."""
    top = np.iinfo(np.int16).max
    for batch in batches:
        counts = []
        for x, own in zip(batch.column(2), batch.column(3)):
            x = np.asarray(x.values)
            if own.is_valid:
                x = x[~np.isin(x, np.asarray(own.values))]
            # a count that doesn't fit stands for any: the bound is then looser
            counts.append(np.minimum(np.bincount(x & (BLOCKS - 1), minlength=BLOCKS), top).astype(np.int16))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.list_(pa.int16()))],
            names=["d", "s", "blocks"])


def _possible(p: str, q: str):
    """Whether the sizes of two nodes, and the numbers of shingles that either
    shares with any other node, allow the threshold."""
    small, large = F.least(f"{p}.n", f"{q}.n"), F.greatest(f"{p}.n", f"{q}.n")
    both = F.least(f"{p}.shared", f"{q}.shared")           # the intersection is no larger
    return (100 * small >= THRESHOLD * large) & (
        (100 + THRESHOLD) * both >= THRESHOLD * (F.col(f"{p}.n") + F.col(f"{q}.n")))


def _by_blocks(p: str, q: str, a: str, b: str):
    """The same by blocks.  A full count says nothing, so it counts as all."""
    top = np.iinfo(np.int16).max
    least = F.zip_with(a, b, lambda x, y: F.least(x, y).cast("long"))
    total = F.aggregate(least, F.lit(0).cast("long"), lambda s, x: s + F.when(x == int(top), 1 << 40).otherwise(x))
    return (100 + THRESHOLD) * total >= THRESHOLD * (F.col(f"{p}.n") + F.col(f"{q}.n"))


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct ordered pairs."""
    return found.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()


def _in_shared_buckets(rows: DataFrame) -> DataFrame:
    """Rows (``key``, ...) whose bucket has more than one of them."""
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return rows.join(shared, "key")


def _own(sets: DataFrame) -> DataFrame:
    """The shingles of each node that no other node has."""
    each = sets.select("doc_id", "s1", F.explode("shingles").alias("x"))
    return (each.groupBy("x").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "s1")).alias("o"))
            .where("c = 1").groupBy("o.doc_id", "o.s1").agg(F.collect_list("x").alias("own")))


def _supported(members: DataFrame, sets: DataFrame, own: DataFrame) -> DataFrame:
    """Members with ``shared``, the number of a node's shingles that any other
    node has, without those that have too few for any link."""
    lone = own.select("doc_id", "s1", F.size("own").cast("long").alias("own"))
    nodes = (sets.select("doc_id", "s1", F.size("shingles").cast("long").alias("n")).distinct()
             .join(lone, ["doc_id", "s1"], "left")
             .select("doc_id", "s1", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"), "n")
             .where(100 * F.col("shared") >= THRESHOLD * F.col("n")).drop("n"))
    nodes = nodes.select(F.col("doc_id").alias("d"), F.col("s1").alias("s"), "shared")
    return members.join(nodes, (F.col("node.doc_id") == F.col("d")) & (F.col("node.s1") == F.col("s"))
                        ).select("key", F.struct("node.doc_id", "node.s1", "node.n", "shared")
                                 .alias("node"))


def _with_blocks(members: DataFrame, sets: DataFrame, own: DataFrame) -> DataFrame:
    left = members.select(F.col("node.doc_id").alias("doc_id"), F.col("node.s1").alias("s1")).distinct()
    counts = materialize(
        sets.join(left, ["doc_id", "s1"]).join(own, ["doc_id", "s1"], "left")
        .select("doc_id", "s1", "shingles", "own").mapInArrow(_block_counts, COUNTS), "minhash-blocks")
    return members.join(counts, (F.col("node.doc_id") == F.col("d")) & (F.col("node.s1") == F.col("s"))) \
        .select("key", "node", "label", "blocks")


def confirm(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``(p, q)`` pairs whose full sets reach the threshold, as ``(a, b)``
    document ids."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("s1").alias("a1"),
                       F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("s1").alias("b1"),
                        F.col("shingles").alias("y"))
    flat = pairs.select(F.col("p.doc_id").alias("a"), F.col("p.s1").alias("a1"),
                        F.col("q.doc_id").alias("b"), F.col("q.s1").alias("b1"))
    common = F.size(F.array_intersect("x", "y"))
    return (flat.join(left, ["a", "a1"]).join(right, ["b", "b1"])
            .select("a", "b", common.alias("both"),
                    (F.size("x") + F.size("y") - common).alias("any"))
            .where(100 * F.col("both") >= THRESHOLD * F.col("any")).select("a", "b"))


def _representatives(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per distinct set, and per ``doc_id`` its ``rows`` and the
    representative of its set (``low`` to ``high`` if its rows have several)."""
    usable = features.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = materialize(usable.groupBy("s1", "s2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")), "minhash-reps")
    named = _represented(features, reps).groupBy("doc_id").agg(
        F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("rows"))
    return reps, materialize(named, "minhash-named")


def _represented(features: DataFrame, reps: DataFrame) -> DataFrame:
    """``(doc_id, rep)`` of every row that has a set."""
    usable = features.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    return usable.select("doc_id", "s1", "s2", "n_shingles").join(
        reps.select("s1", "s2", "n_shingles", "rep"), ["s1", "s2", "n_shingles"]).select("doc_id", "rep")


def _linked(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links: the ones found so far are stars already."""
    edges = links.select("a", "b")
    if label is not None:
        edges = edges.union(label.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return components(edges, "minhash-components")


def link_components(docs: DataFrame, reps: DataFrame, named: DataFrame) -> DataFrame | None:
    """``(node, component)`` of the representatives that the threshold
    connects, by confirmed links; None if no two of them share a bucket."""
    rows = reps.select(
        F.explode("bands").alias("key"),
        F.struct(F.col("rep").alias("doc_id"), "s1", F.col("n_shingles").alias("n")).alias("node"))
    members = materialize(_in_shared_buckets(rows), "minhash-members")
    if members.isEmpty():
        return None
    # the full sets of the documents in shared buckets, shingled again
    nodes = materialize(members.select("node.doc_id").distinct(), "minhash-nodes")
    sets = join_keys(docs, nodes, ["doc_id"]).mapInArrow(_full_sets, SETS)
    if not named.where("rows > 1").isEmpty():
        sets = sets.dropDuplicates(["doc_id", "s1"])      # a set once, however often its row repeats
    sets = materialize(sets, "minhash-sets")
    own = materialize(_own(sets), "minhash-own")
    members = materialize(_in_shared_buckets(_supported(members, sets, own)), "minhash-members")

    tested = None    # compared so far
    label = None     # component of each linked document
    last = False     # whether what is left is compared across components
    round_no = size = 0
    while not members.isEmpty():
        if not last:
            turn = F.struct(F.xxhash64("node.doc_id", F.lit(round_no)), "node")
            if round_no == 0:
                turn = F.struct(F.lit(0), "node")
            pivot = members.groupBy("key").agg(F.min(turn).alias("t")).select(
                "key", F.col("t.node").alias("p"))
            found = members.withColumnRenamed("node", "q").join(pivot, "key")
            found = found.where((F.col("p") != F.col("q")) & _possible("p", "q"))
        else:
            members = materialize(_with_blocks(members, sets, own), "minhash-members")
            found = members.select("key", F.col("node").alias("q"), "label", F.col("blocks").alias("qb")).join(
                members.select("key", F.col("node").alias("p"), F.col("label").alias("other"),
                               F.col("blocks").alias("pb")), "key")
            found = found.where((F.col("label") < F.col("other")) & _possible("p", "q")
                                & _by_blocks("p", "q", "pb", "qb"))
        found = _pairs(found)
        if tested is not None:
            found = found.join(tested, ["p", "q"], "leftanti")
        found = materialize(found, "minhash-pairs")
        if not found.isEmpty():
            new = materialize(confirm(sets, found), "minhash-links")
            tested = found if tested is None else tested.union(found)
            if not new.isEmpty():
                label = _linked(label, new)
        if last:
            break
        # only buckets that still hold several components go on
        named = members.select("key", "node")
        if label is not None:
            named = named.join(label.withColumnRenamed("node", "id"),
                               F.col("node.doc_id") == F.col("id"), "left").select(
                "key", "node", F.coalesce("component", "node.doc_id").alias("label"))
        else:
            named = named.withColumn("label", F.col("node.doc_id"))
        mixed = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
        mixed = mixed.where(F.col("x") < F.col("y")).select("key")
        before = size or members.count()
        members = materialize(named.join(mixed, "key"), "minhash-members")
        size = members.count()
        round_no += 1
        last = round_no == PIVOT_ROUNDS or size > (1 - LEAST_FINISHED) * before
    return label


def near_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``
    (columns ``doc_id`` and ``text``; other columns are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable over links of
    similarity 0.75 or more between sets of 5-word shingles; ``kept`` is
    ``doc_id = component_id``.

    * A null or empty text, or one without words, has an empty set and no link.
    * Rows that repeat a ``doc_id`` are one node: they share its component and
      all of them are kept if it is.
    * A row with a null ``doc_id`` cannot be named by a link: it is returned
      with a null component and kept.
    * An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = materialize(docs.mapInArrow(_features, FEATURES), "minhash-features")
    reps, named = _representatives(features)
    label = link_components(docs, reps, named)
    several = named.where("low < high")
    if not several.isEmpty():                   # rows with one id and different sets are one node
        ties = _represented(features, reps).join(several.select("doc_id", "low"), "doc_id").where(
            F.col("rep") != F.col("low")).select(F.col("rep").alias("a"), F.col("low").alias("b"))
        label = _linked(label, ties)
    found = named.select("doc_id", F.col("low").alias("component"))
    if label is not None:
        # a representative is its set's smallest id, so their smallest is the component's
        found = named.join(label, F.col("low") == F.col("node"), "left").select(
            "doc_id", F.coalesce("component", "low").alias("component"))
    out = features.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
