"""Packing tokenised documents into fixed-length sequences with a grouping
genetic algorithm.

Documents are tokenised in the tasks; one longer than a sequence is cut into
whole sequences and one shorter first piece.  The shorter pieces are dealt by
hash into blocks of about ``BLOCK`` pieces.  Each block is evolved on
``ISLANDS`` islands: a solution is a set of bins, the first ones come from
best-fit orders, and crossover injects some of the fuller half of one parent's
bins into another, removes the bins that repeat their pieces, opens some of the emptiest and
best-fits the displaced ones.  Generations follow until ``PATIENCE`` of them
bring nothing better.  Between epochs the elite of each island moves to the next one.  The
bins that stay poorly filled in the best solution are opened, and their pieces
are dealt anew in the next round, until one block is left or a round no longer
fills bins well.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import materialize, ship_package

SEQUENCE = 2048
END_ID = 0
BLOCK = 2048          # pieces
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
PATIENCE = 8          # generations without a better solution that end an epoch
OPENED = 0.3          # of the bins that crossover leaves in place, at most
WELL_FILLED = 0.985   # of a sequence
GAIN = 0.8            # a round that leaves more of its pieces open is the last

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokens -----------------------------------------------------------------

# Where both tokenizer libraries are known to split alike: tab, line ends,
# printable ASCII and Latin letters.  Other texts take the slower library.
_PLAIN = r"[\t\n\r\x20-\x7E¡-ɏ]*"


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Text to ids of the byte-level BPE in a ``tokenizers`` file.

    The file's vocabulary and merges are also loaded as ranks into a faster
    encoder, used for plain texts without special tokens.
    """
    import json
    import re

    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = [t["content"] for t in model.get("added_tokens", [])]
    # byte-level vocabularies write byte b as the printable character below
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items()
             if token not in special}
    split = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
             r"|\s+(?!\S)|\s+")
    fast = tiktoken.Encoding("byte_bpe", pat_str=split, mergeable_ranks=ranks, special_tokens={})
    plain = re.compile(_PLAIN)

    def encode(text: str) -> np.ndarray:
        if plain.fullmatch(text) and not any(s in text for s in special):
            ids = fast.encode_ordinary(text)
        else:
            ids = slow.encode(text, add_special_tokens=False).ids
        out = np.empty(len(ids) + 1, "<u4")
        out[:-1] = ids
        out[-1] = END_ID
        return out

    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(n: int, most: int = SEQUENCE) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids: whole
    sequences, after a shorter first piece if they don't come out even."""
    first = n % most if n % most else min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def tokenise(docs: DataFrame, tokenizer: str | None = None, most: int = SEQUENCE,
             with_ids: bool = False) -> DataFrame:
    """A row per piece of each row of ``docs`` (``doc_id``, ``text``); with
    ``with_ids`` also the ids themselves."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer or default_tokenizer())    # the executor's own file
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "")
                for piece, (start, length) in enumerate(pieces(len(ids), most)):
                    part = ids[start:start + length]
                    row = (doc_id, piece, start, length, zlib.crc32(part.tobytes()),
                           part if with_ids else None)
                    for column, value in zip(out, row):
                        column.append(value)
                if len(out[0]) >= 4096:
                    yield _batch(out, with_ids)
                    out = [[], [], [], [], [], []]
            yield _batch(out, with_ids)

    schema = PIECES + (", ids array<long>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _batch(out: list[list], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(v, t) for v, t in zip(out, kinds)]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        arrays.append(pa.array([v.astype(np.int64) for v in out[5]], pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)


# --- the genetic algorithm on one block --------------------------------------

Bins = list[list[int]]


def best_fit(order, size: list[int], bins: Bins, most: int) -> Bins:
    """Put each item of ``order`` into the fullest bin that has room."""
    room = sorted((most - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in order:
        at = bisect_left(room, (size[i], -1))
        if at == len(room):
            bins.append([i])
            insort(room, (most - size[i], len(bins) - 1))
        else:
            left, k = room.pop(at)
            bins[k].append(i)
            insort(room, (left - size[i], k))
    return bins


def fitness(bins: Bins, size: list[int]) -> tuple[int, int]:
    """Fewer bins first, then the sum of squared fills (higher is better)."""
    return -len(bins), sum(sum(size[i] for i in b) ** 2 for b in bins)


def crossover(a: Bins, b: Bins, size: list[int], most: int, rng) -> Bins:
    """Inject half of the fuller half of ``b``'s bins into ``a``, and open up to
    ``OPENED`` of the bins of ``a`` that stay, the emptiest first."""
    def fill(x: list[int]) -> int:
        return sum(size[i] for i in x)

    good = sorted(b, key=fill, reverse=True)[:max(1, len(b) // 2)]
    chosen = [good[k] for k in rng.permutation(len(good))[:max(1, len(good) // 2)]]
    taken = {i for x in chosen for i in x}
    kept, displaced = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in taken]
    kept.sort(key=fill)
    opened = int(len(kept) * OPENED * rng.random())
    displaced += [i for x in kept[:opened] for i in x]
    kept = kept[opened:]
    displaced.sort(key=lambda i: -size[i])
    return best_fit(displaced, size, kept + [list(x) for x in chosen], most)


def evolve(size: list[int], elite: list[int] | None, seed: int, most: int = SEQUENCE) -> list[int]:
    """One epoch on an island: the bin of each item in the best solution.
    ``elite`` is the solution that migrated here, if any."""
    n = len(size)
    least = math.ceil(sum(size) / most)
    rng = np.random.default_rng(seed)
    population: list[Bins] = []
    if elite is not None:
        moved: dict[int, list[int]] = {}
        for i, k in enumerate(elite):
            moved.setdefault(k, []).append(i)
        population.append(list(moved.values()))
    falling = sorted(range(n), key=lambda i: -size[i])
    population.append(best_fit(falling, size, [], most))
    scale = max(1, most // 16)
    while len(population) < POPULATION and min(map(len, population)) > least:
        noise = rng.integers(0, scale, n)
        population.append(best_fit(sorted(range(n), key=lambda i: -size[i] - noise[i]),
                                   size, [], most))
    # by fitness, one solution for each; a child with a known fitness is no news
    known = {fitness(p, size): p for p in reversed(population)}
    idle = 0
    while idle < PATIENCE and len(known) > 1 and -max(known)[0] > least:
        a, b = rng.permutation(len(known))[:2]
        ranked = sorted(known, reverse=True)
        child = crossover(known[ranked[a]], known[ranked[b]], size, most, rng)
        known.setdefault(fitness(child, size), child)
        if len(known) > POPULATION:
            del known[min(known)]
        idle = 0 if max(known) > ranked[0] else idle + 1
    out = [0] * n
    for k, x in enumerate(known[max(known)]):
        for i in x:
            out[i] = k
    return out


_ISLANDS = "block long, island int, length array<int>, best array<int>, bins int, fill double"


def _epoch(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                best = evolve(row["length"], row["elite"],
                              (row["block"] * 31 + row["island"]) * 31 + row["epoch"], most)
                fill: dict[int, int] = {}
                for size, k in zip(row["length"], best):
                    fill[k] = fill.get(k, 0) + size
                yield pa.RecordBatch.from_pylist([{
                    "block": row["block"], "island": row["island"], "length": row["length"],
                    "best": best, "bins": len(fill),
                    "fill": sum((v / most) ** 2 for v in fill.values())}],
                    schema=pa.schema([("block", pa.int64()), ("island", pa.int32()),
                                      ("length", pa.list_(pa.int32())),
                                      ("best", pa.list_(pa.int32())), ("bins", pa.int32()),
                                      ("fill", pa.float64())]))
    return run


def pack_blocks(items: DataFrame, most: int) -> DataFrame:
    """``(block, best)``: the best solution of each block of items, where
    ``items`` is ``(block, length array)``."""
    start = items.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                         "length", F.lit(None).cast("array<int>").alias("elite"))
    islands = None
    for epoch in range(EPOCHS):
        if islands is not None:
            elites = islands.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"),
                                    F.col("best").alias("elite"))
            start = islands.select("block", "island", "length").join(elites, ["block", "island"])
        islands = materialize(start.withColumn("epoch", F.lit(epoch))
                              .mapInArrow(_epoch(most), _ISLANDS), "islands")
    order = F.struct(-F.col("bins"), F.col("fill"), -F.col("island"))
    return islands.groupBy("block").agg(F.max_by("best", order).alias("best"))


def pack(cut: DataFrame, most: int = SEQUENCE) -> DataFrame:
    """Assign the rows of ``tokenise`` (a written table) to sequences: adds
    ``sequence_id`` and ``offset``."""
    whole = cut.where(F.col("length") == most).select(
        *cut.columns, (-F.monotonically_increasing_id() - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    item = F.struct(F.col("length").cast("int").alias("length"), "doc_id", "piece", "start",
                    "ids_crc32")
    open_items = cut.where(F.col("length") < most).select(item.alias("item"))
    n, turn, out = open_items.count(), 0, whole
    while n:
        blocks = math.ceil(n / BLOCK)
        dealt = F.pmod(F.xxhash64("item.doc_id", "item.piece", "item.ids_crc32", F.lit(turn)),
                       F.lit(blocks))
        grouped = materialize(open_items.groupBy(dealt.alias("block")).agg(
            F.array_sort(F.collect_list("item")).alias("items")), "pack-blocks")
        best = pack_blocks(grouped.select("block", F.col("items.length").alias("length")), most)
        both = F.arrays_zip(F.col("items").alias("item"), F.col("best").alias("bin"))
        bins = materialize(
            grouped.join(best, "block").select("block", F.explode(both).alias("x"))
            .groupBy("block", F.col("x.bin").alias("bin"))
            .agg(F.array_sort(F.collect_list("x.item")).alias("items"),
                 F.sum("x.item.length").alias("fill")), "pack-bins")
        well = F.col("fill") >= WELL_FILLED * most
        left = bins.where(~well).agg(F.sum(F.size("items"))).first()[0] or 0
        last = blocks == 1 or left > GAIN * n
        before = F.expr("transform(items, (x, i) -> aggregate(slice(items, 1, i), 0L, "
                        "(s, y) -> s + y.length))")
        full = (bins if last else bins.where(well)).select(
            (F.lit(turn << 56) + F.col("block") * F.lit(1 << 20) + F.col("bin"))
            .alias("sequence_id"),
            F.explode(F.arrays_zip(F.col("items").alias("item"), before.alias("offset")))
            .alias("x"))
        out = out.unionByName(full.select(
            "x.item.doc_id", "x.item.piece", "x.item.start",
            F.col("x.item.length").cast("long").alias("length"), "x.item.ids_crc32",
            "sequence_id", F.col("x.offset").alias("offset")))
        if last:
            break
        open_items = bins.where(~well).select(F.explode("items").alias("item"))
        n, turn = left, turn + 1
    return out


def best_fit_packing(docs: DataFrame, tokenizer: str | None = None,
                     most: int = SEQUENCE) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per
    piece of each row of ``docs`` (``doc_id``, ``text``; other columns are
    ignored).

    A null or empty text is the end id alone.  Rows that repeat, and rows with
    a null ``doc_id``, are packed each on their own.  An empty table gives an
    empty result.
    """
    return pack(materialize(tokenise(docs, tokenizer, most), "pieces"), most)
