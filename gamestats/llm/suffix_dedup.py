"""Repeated passages with a difference-cover suffix array.

Every byte covered by a ``LENGTH``-byte string that also starts earlier is
removed.  Sorting all suffixes of a large corpus moves many times its size, so
an exact filter goes first:

1. Anchors.  A position is an anchor if the hash of the ``CORE`` bytes there is
   the smallest of some ``LENGTH - CORE + 1`` neighbouring ones.  Equal strings
   of ``LENGTH`` bytes have the same anchor at the same place, so only
   occurrences of one anchor can be equal.  The string around an anchor that
   all its windows cover is its context.
2. Occurrences with equal anchor and context (128 bits) are one class.  All but
   the first are covered whole.  Classes are combined in the map tasks, so
   copies reach a task as one row per map task and class.
3. Only where one anchor has several classes (the ends of repeated passages)
   the windows have to be compared: the contexts of the first occurrences are
   dealt by anchor to tasks, and each task builds the suffix array of its
   contexts by the difference-cover algorithm: it sorts the triples at the
   places 1 and 2 modulo 3, names them, recurses on the names, sorts the
   remaining suffixes by their first byte and the rank behind it, merges both
   and compares the first ``LENGTH`` bytes of neighbours.
   Anchors with more than ``HOT`` contexts are split first: one half of their
   windows shares a longer string to the left, the other one to the right, and
   so on until the windows themselves are compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import (
    BROADCAST_ROWS,
    materialize,
    ship_package,
    with_global_rank,
)
from gamestats.llm.shingles import BYTE, mix, power_tables, slices

LENGTH = 100                    # bytes
CORE = 50                       # bytes hashed at an anchor
WINDOWS = LENGTH - CORE + 1     # windows around an anchor
SLICE_BYTES = 256 << 10         # text hashed at a time: some 100 bytes of memory for each
FLUSH = 400_000                 # anchors combined in a map task at a time
BUCKET_BYTES = 8 << 20          # text whose anchors share a bucket, on average,
MANY_BUCKETS = 1024             # up to so many buckets;
LARGE_BUCKET_BYTES = 64 << 20   # and at most, beyond
CONTEXTS = 8_000                # contexts that share a task, on average
HOT = 20_000                    # contexts of one anchor that are not split

_U = np.uint64
_RECORD = np.dtype([("core", "<i8"), ("context", "<i8"), ("doc", "<i8"), ("at", "<i4"),
                    ("lo", "<i2"), ("hi", "<i2")])


# --- anchors --------------------------------------------------------------------

def _slide(x: np.ndarray, width: int, fold, filler) -> np.ndarray:
    """``fold`` (minimum or maximum) over every ``width`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // width) * width, filler, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = fold.accumulate(rows, axis=1).ravel()
    back = fold.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(back[:n - width + 1], ahead[width - 1:n])


def find_anchors(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of concatenated texts: place, text number, first and end byte of
    the context, and the hashes of core and context."""
    n = len(buf)
    none = (np.empty(0, np.int64),) * 4 + (np.empty(0, np.int64),) * 2
    if n < LENGTH:
        return none
    power, inverse = power_tables(n + 1)
    run = np.zeros(n + 1, _U)
    np.cumsum(BYTE[buf] * power[:n], out=run[1:])
    core = mix((run[CORE:] - run[:-CORE]) * inverse[:n - CORE + 1])
    low = _slide(core, WINDOWS, np.minimum, _U(2 ** 64 - 1))     # of each 100-byte window
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # windows that cross the end of a text don't count
    inside = text[:n - LENGTH + 1] == text[LENGTH - 1:]
    low = np.where(inside, low, _U(0))
    padded = np.concatenate([np.zeros(WINDOWS - 1, _U), low, np.zeros(WINDOWS - 1, _U)])
    chosen = np.flatnonzero((_slide(padded, WINDOWS, np.maximum, _U(0)) == core) & (core != 0))
    if not len(chosen):
        return none
    owner = text[chosen]
    first = np.maximum(bounds[owner], chosen - (WINDOWS - 1))
    end = np.minimum(bounds[owner + 1], chosen + LENGTH)
    context = mix((run[end] - run[first]) * inverse[first]
                  + ((chosen - first) * 1024 + (end - first)).astype(_U))
    return chosen, owner, first, end, core[chosen].view(np.int64), context.view(np.int64)


def _classes(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first record of each class, sorted by core and context, and the
    records behind it.  Records of one place are the same occurrence."""
    rec = rec[np.lexsort((rec["at"], rec["doc"], rec["context"], rec["core"]))]
    new = np.ones(len(rec), bool)
    new[1:] = (rec["core"][1:] != rec["core"][:-1]) | (rec["context"][1:] != rec["context"][:-1])
    first = rec[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = (rec["doc"] != first["doc"]) | (rec["at"] != first["at"])
    return rec[new], rec[later]


def _merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of the intervals of each document."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    start_of_doc = np.r_[True, doc[1:] != doc[:-1]]
    group = np.cumsum(start_of_doc) - 1
    wide = int(hi.max()) + 1
    reach = np.maximum.accumulate(hi + group * wide) - group * wide  # farthest end so far
    new = start_of_doc | np.r_[True, lo[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    return doc[at], lo[at], reach[np.r_[at[1:] - 1, len(doc) - 1]]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Texts as ``((doc_id, start), bytes)``; long ones in pieces that overlap,
    so that every window is in one of them."""
    for batch in batches:
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = (value.as_py() or "").encode()
            for start in range(0, max(1, len(text) - LENGTH), SLICE_BYTES):
                piece = text[start:start + SLICE_BYTES + 2 * LENGTH]
                if len(piece) >= LENGTH:
                    yield (doc_id, start), piece


_MAPPED = "bucket int, records binary, doc_id long, lo int, hi int"


def _map_anchors(buckets: int):
    """Anchors of the texts, combined by class and dealt to buckets by core;
    occurrences behind the first of their class in the task are covered."""
    def deal(parts: list[np.ndarray]) -> pa.RecordBatch:
        rec = np.concatenate(parts) if parts else np.empty(0, _RECORD)
        rec, rest = _classes(rec)
        doc, lo, hi = _merged(rest["doc"], rest["at"] - rest["lo"], rest["at"] + rest["hi"])
        bucket = (rec["core"].view(_U) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rec, bucket = rec[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(rec) else np.empty(0, int)
        blobs = [rec[a:b].tobytes() for a, b in zip(cuts, np.r_[cuts[1:], len(rec)])]
        none = [0] * len(blobs)      # not null: pandas would turn the ids into floats
        # covered intervals travel beside the records, spread over the buckets
        side = (doc % buckets).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array([*bucket[cuts].tolist(), *side.tolist()], pa.int32()),
            pa.array([*blobs, *[None] * len(doc)], pa.binary()),
            pa.array([*none, *doc.tolist()], pa.int64()),
            pa.array([*none, *lo.tolist()], pa.int32()),
            pa.array([*none, *hi.tolist()], pa.int32())],
            names=["bucket", "records", "doc_id", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in slices(_pieces(batches), SLICE_BYTES):
            own = np.array([p[0][0] for p in part], np.int64)
            begin = np.array([p[0][1] for p in part], np.int64)
            bounds = np.cumsum([0] + [len(p[1]) for p in part])
            at, owner, first, end, core, context = find_anchors(
                np.frombuffer(b"".join(p[1] for p in part), np.uint8), bounds)
            rec = np.empty(len(at), _RECORD)
            rec["core"], rec["context"], rec["doc"] = core, context, own[owner]
            rec["at"] = at - bounds[owner] + begin[owner]
            rec["lo"], rec["hi"] = at - first, end - at
            parts.append(rec)
            held += len(rec)
            if held >= FLUSH:
                yield deal(parts)
                parts, held = [], 0
        yield deal(parts)
    return run


_JUDGED = "doc_id long, lo int, hi int, at int, core long"


def _judge_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Classes of one bucket: covered intervals (``lo``, ``hi``; ``at`` null)
    and, of anchors with several classes, the first occurrence of each class
    (``lo`` and ``hi`` of its context, ``at``, ``core``)."""
    blobs = [b for b in pdf["records"] if b is not None]
    rec = np.concatenate([np.frombuffer(b, _RECORD) for b in blobs]) if blobs else np.empty(0, _RECORD)
    rec, rest = _classes(rec)
    given = pdf["records"].isna().to_numpy()
    doc = np.concatenate([rest["doc"], pdf["doc_id"][given].to_numpy(np.int64)])
    lo = np.concatenate([rest["at"] - rest["lo"], pdf["lo"][given].to_numpy(np.int64)])
    hi = np.concatenate([rest["at"] + rest["hi"], pdf["hi"][given].to_numpy(np.int64)])
    doc, lo, hi = _merged(doc, lo, hi)
    begin = np.r_[True, rec["core"][1:] != rec["core"][:-1]] if len(rec) else np.empty(0, bool)
    group = np.cumsum(begin) - 1
    several = rec[np.bincount(group)[group] > 1] if len(rec) else rec
    return pd.DataFrame({
        "doc_id": np.concatenate([doc, several["doc"]]),
        "lo": np.concatenate([lo, several["at"] - several["lo"]]).astype(np.int32),
        "hi": np.concatenate([hi, several["at"] + several["hi"]]).astype(np.int32),
        "at": pd.array([*[None] * len(doc), *several["at"].tolist()], "Int32"),
        "core": pd.array([*[None] * len(doc), *several["core"].tolist()], "Int64")})


# --- the difference-cover suffix array ------------------------------------------

def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the name (1, 2, ...) of each key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    name = np.cumsum(np.r_[1, (ordered[1:] != ordered[:-1]).astype(np.int64)])
    names = np.empty(len(keys), np.int64)
    names[order] = name
    return order, names


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of a sequence of numbers > 0, sorted, by the difference cover
    {1, 2} modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.zeros(n + 3, np.int64)
    t[:n] = s
    k = int(t.max()) + 1
    if k ** 3 >= 2 ** 62:            # rename large alphabets
        t[:n] = _ranked(t[:n])[1]
        k = int(t.max()) + 1
    # the place n counts when n is 1 modulo 3, so that the samples stay apart
    ones = np.arange(1, n + (n % 3 == 1), 3)
    sample = np.concatenate([ones, np.arange(2, n, 3)])
    triples = ((t[sample] * k + t[sample + 1]) * k + t[sample + 2] if k ** 3 < 2 ** 62 else
               _ranked(_ranked(t[sample] * k + t[sample + 1])[1] * k + t[sample + 2])[1])
    order, names = _ranked(triples)
    if names.max() < len(sample):    # equal triples: recurse on the names
        order = suffix_array(names)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    by_rank = sample[order]
    by_rank = by_rank[by_rank < n]
    wide = len(sample) + 2
    # the rest: by first symbol and the rank behind it
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(t[rest] * wide + rank[rest + 1], kind="stable")]
    # merge: before a rest suffix come the ones and the twos that are smaller
    one, two = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    smaller = np.searchsorted(t[one] * wide + rank[one + 1], t[rest] * wide + rank[rest + 1])
    pair = lambda i: _pair_key(t, rank, i, k, wide)
    smaller = smaller + np.searchsorted(pair(two), pair(rest))
    out = np.empty(n, np.int64)
    place = np.arange(len(rest)) + smaller
    free = np.ones(n, bool)
    free[place] = False
    out[place] = rest
    out[free] = by_rank
    return out


def _pair_key(t: np.ndarray, rank: np.ndarray, i: np.ndarray, k: int, wide: int) -> np.ndarray:
    """Two symbols and the rank behind them."""
    return (t[i] * k + t[i + 1]) * wide + rank[i + 2]


def repeated_windows(contexts: list[bytes], doc: np.ndarray, start: np.ndarray,
                     first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents and places of the windows that also start earlier.  Context
    ``c`` begins at ``start[c]`` of ``doc[c]``; its windows begin ``first[c]``
    to ``last[c]`` bytes into it."""
    sizes = np.array([len(c) for c in contexts])
    base = np.cumsum(np.r_[0, sizes[:-1] + 1])
    joined = np.frombuffer(b"\x00".join(contexts) + b"\x00", np.uint8)
    symbols = joined.astype(np.int64) + 2
    symbols[base[1:] - 1] = 1        # between contexts
    symbols[-1] = 1
    counts = np.maximum(0, np.minimum(last, sizes - LENGTH) - first + 1)
    which = np.repeat(np.arange(len(contexts)), counts)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]
    of_place = np.full(len(symbols), -1, np.int64)
    of_place[base[which] + inner] = np.arange(len(which))
    order = suffix_array(symbols)
    windows = of_place[order]
    windows = windows[windows >= 0]
    if not len(windows):
        return doc[:0], start[:0]
    at = base[which[windows]] + inner[windows]
    same = np.zeros(len(windows), bool)
    for a in range(1, len(windows), 1 << 16):           # compare adjacent prefixes
        b = min(len(windows), a + (1 << 16))
        rows = joined[at[a - 1:b, None] + np.arange(LENGTH)[None, :]]
        same[a:b] = (rows[1:] == rows[:-1]).all(axis=1)
    group = np.cumsum(~same) - 1
    docs, places = doc[which[windows]], start[which[windows]] + inner[windows]
    ordered = np.lexsort((places, docs, group))
    g, d, p = group[ordered], docs[ordered], places[ordered]
    begin = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    lengths = np.diff(np.r_[begin, len(g)])
    later = (d != np.repeat(d[begin], lengths)) | (p != np.repeat(p[begin], lengths))
    return d[later], p[later]


_WINDOWS = "doc_id long, lo int, hi int"


def _compare_contexts(pdf: pd.DataFrame) -> pd.DataFrame:
    at = pdf["at"].to_numpy(np.int64)
    doc, place = repeated_windows(
        list(pdf["context"]), pdf["doc_id"].to_numpy(np.int64), pdf["lo"].to_numpy(np.int64),
        np.maximum(0, at - pdf["far"].to_numpy(np.int64)), at - pdf["near"].to_numpy(np.int64))
    doc, lo, hi = _merged(doc, place, place + LENGTH)
    return pd.DataFrame({"doc_id": doc, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})


# --- the distributed steps --------------------------------------------------------

def _split_hot(contexts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Split the windows of keys with more than ``HOT`` contexts in halves that
    share a longer string.  ``at`` is the anchor's place in the context;
    windows begin ``near`` to ``far`` bytes before it.  Returns contexts to
    sort, and the windows themselves of keys that stay hot."""
    done, windows = [], None
    while True:
        hot = materialize(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                          .where(F.col("n") > HOT).select("key"), "hot-anchors")
        if hot.isEmpty():
            done.append(contexts)
            break
        done.append(contexts.join(hot, "key", "leftanti"))
        wide = contexts.join(hot, "key")
        if wide.where(F.col("near") < F.col("far")).isEmpty():
            windows = wide
            break
        half = F.floor((F.col("near") + F.col("far")) / 2).cast("int")
        ranges = F.when(F.col("near") == F.col("far"), F.array(F.struct("near", "far"))).otherwise(
            F.array(F.struct("near", half.alias("far")), F.struct((half + 1).alias("near"), "far")))
        halves = wide.select("doc_id", "lo", "context", "key", "at", F.explode(ranges).alias("x"))
        near, far = F.col("x.near"), F.col("x.far")
        some = F.greatest(near, F.col("at") + LENGTH - F.octet_length("context")) <= F.least(
            far, F.col("at"))
        core = F.substring("context", F.col("at") - near + 1, F.lit(LENGTH) - far + near)
        contexts = materialize(halves.where(some).select(
            "doc_id", "lo", "context", F.xxhash64("key", near, far, core).alias("key"), "at",
            near.alias("near"), far.alias("far")), "split-contexts")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, windows


def covered_bytes(docs: DataFrame) -> DataFrame:
    """``(doc_id, lo, hi)`` intervals of removed bytes of ``docs`` (``doc_id``
    not null and not repeated, ``text``)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / LARGE_BUCKET_BYTES),
                  min(MANY_BUCKETS, math.ceil(size / BUCKET_BYTES)))
    mapped = docs.mapInArrow(_map_anchors(buckets), _MAPPED)
    judged = materialize(mapped.groupBy("bucket").applyInPandas(_judge_bucket, _JUDGED), "anchors")
    covered = judged.where(F.col("at").isNull()).select("doc_id", "lo", "hi")
    several = judged.where(F.col("at").isNotNull())
    n = several.count()
    if not n:
        return covered
    wanted = materialize(several.groupBy("doc_id").agg(
        F.collect_list(F.struct("lo", "hi", "at", "core")).alias("x")), "anchor-places")
    if n <= BROADCAST_ROWS:          # places of 24 bytes
        wanted = F.broadcast(wanted)
    contexts = materialize(
        docs.join(wanted, "doc_id").select("doc_id", F.col("text").cast("binary").alias("b"),
                                           F.explode("x").alias("x"))
        .select("doc_id", "x.lo", F.substring("b", F.col("x.lo") + 1, F.col("x.hi") - F.col("x.lo"))
                .alias("context"), F.col("x.core").alias("key"),
                (F.col("x.at") - F.col("x.lo")).alias("at"), F.lit(0).alias("near"),
                F.lit(WINDOWS - 1).alias("far")), "contexts")
    contexts, windows = _split_hot(contexts)
    tasks = max(1, math.ceil(n / CONTEXTS))
    found = contexts.groupBy(F.pmod("key", F.lit(tasks)).alias("task")).applyInPandas(
        _compare_contexts, _WINDOWS)
    out = covered.unionByName(found)
    if windows is not None:          # one window per row, equal within a key
        at = windows.select("key", "doc_id", (F.col("lo") + F.col("at") - F.col("near")).alias("p"))
        first = at.groupBy("key").agg(F.min(F.struct("doc_id", "p")).alias("e"))
        out = out.unionByName(at.join(first, "key").where(
            F.struct("doc_id", "p") != F.col("e"))
            .select("doc_id", F.col("p").alias("lo"), (F.col("p") + LENGTH).alias("hi")))
    return out


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"


def _apply_cuts(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                text = (batch.column(1)[k].as_py() or "").encode()
                cuts = sorted(tuple(c.values()) for c in batch.column(2)[k].as_py() or [])
                kept, at, removed, spans = [], 0, 0, 0
                for lo, hi in cuts:
                    if lo > at or not spans:
                        spans += 1
                        kept.append(text[at:lo])
                        removed += hi - lo
                        at = hi
                    elif hi > at:
                        removed += hi - at
                        at = hi
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append({"doc_id": doc_id, "n_bytes": len(text), "n_removed": removed,
                            "n_spans": spans, "kept_sha256": hashlib.sha256(rest).hexdigest(),
                            "text": rest.decode("utf-8", "replace") if with_text else None})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())]))
    return run


def suffix_dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of
    ``docs`` (``doc_id``, ``text``; other columns are ignored), and with
    ``with_text`` the remaining text (bytes cut out of a character leave a
    replacement character).

    * Texts are UTF-8 bytes, a null text none; a text below 100 bytes has
      nothing to remove.
    * Rows that repeat a ``doc_id`` and its text are one document, and each gets
      its result.  Of rows that repeat a ``doc_id`` with different texts, those
      with the smallest hash of the text are the document.
    * The other ones, and rows with a null ``doc_id``, are documents of their
      own that come after all these, by ``doc_id`` (null last) and hash of the
      text: each is cut like any document.
    * An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    ids = materialize(docs.select("doc_id", mark.alias("mark")).groupBy("doc_id")
                      .agg(F.min("mark").alias("mark"), F.max("mark").alias("other"),
                           F.count(F.lit(1)).alias("n"))
                      .where(F.col("doc_id").isNull() | (F.col("mark") != F.col("other"))), "odd-ids")
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("place", F.col("doc_id"))
    if not ids.isEmpty():            # rows that don't stand for their id
        marked = (docs.withColumn("_mark", mark)
                  .join(ids.select("doc_id", "mark").where(F.col("doc_id").isNotNull()), "doc_id", "left"))
        stands = F.col("doc_id").isNotNull() & (F.col("mark").isNull() | (F.col("mark") == F.col("_mark")))
        named = marked.where(stands).select("doc_id", "text", F.col("doc_id").alias("place"))
        stray = with_global_rank(
            marked.where(~stands).select("doc_id", "text", "_mark")
            .withColumn("_tie", F.monotonically_increasing_id()),
            [F.col("doc_id").asc_nulls_last(), F.col("_mark"), F.col("_tie")], "_rank")
        top = docs.agg(F.max("doc_id")).first()[0] or 0
        # places beyond the largest id; ids near the end of the range move down
        room = 2 ** 63 - 2 - top - (ids.agg(F.sum("n")).first()[0] or 0)
        named = named.withColumn("place", F.col("place") + F.lit(min(0, room)))
        named = named.unionByName(stray.select(
            "doc_id", "text", (F.col("_rank") + F.lit(top + 1 + min(0, room))).alias("place")))
    spans = covered_bytes(named.select(F.col("place").alias("doc_id"), "text"))
    per_doc = materialize(spans.groupBy(F.col("doc_id").alias("place")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("cuts"), F.count(F.lit(1)).alias("n")), "cuts")
    if (per_doc.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_ROWS:
        per_doc = F.broadcast(per_doc)
    cut = named.join(per_doc.drop("n"), "place", "left").select("doc_id", "text", "cuts")
    out = cut.mapInArrow(_apply_cuts(with_text), _DIGEST)
    return out if with_text else out.drop("text")
