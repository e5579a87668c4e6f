"""Toxicity by compression distance: two zstandard dictionaries, one trained on
toxic text and one on ordinary text, and the lengths that each gives.

A window is a word: a run of letters (ASCII letters and all other bytes from 80
up, A-Z lower-cased), in pieces of at most ``WIDTH`` bytes.  It is compressed
with either dictionary; its difference is the number of bytes that the toxic
dictionary saves.  A document has as many hits at a threshold as it has windows
with a difference of at least that, and a logistic model weighs the hits at all
thresholds against the number of windows.

* The dictionaries are trained on a bounded sample: up to ``TOXIC_DOCS`` and
  ``ORDINARY_DOCS`` labelled documents by hash of the id, of each a stretch of
  ``SAMPLE_CHARS`` characters at a place given by the same hash.  The toxic
  trainer sees the stretches of toxic text that set it apart: those covered by
  byte strings that significantly more toxic than ordinary documents hold.  Of
  the ``SETTINGS`` of string lengths and dictionary size, the one is taken that
  does best on a quarter of the sample when trained on the rest.
* The weights of the thresholds are calibrated on all labelled documents of the
  half that the sample isn't drawn from.
* Held-out documents are in neither half.

A word is written ``COPIES`` times, or the least gain that zstandard asks for
before it compresses a block would hide its length; the dictionaries are used
as raw content, so that a literal costs a byte and matches alone decide.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import materialize, ship_package

WIDTH = 32                  # bytes in a window
COPIES = 8
# lengths of distinctive strings, bytes of the toxic dictionary
SETTINGS = (((5,), 1024), ((5,), 2048), ((5, 8), 1024), ((5, 8), 2048))
SIGNIFICANT = 25            # least log-likelihood ratio of a distinctive string
LEAST_RATIO = 8             # of its shares of toxic and of ordinary documents
ORDINARY_BYTES = 4096
SEGMENT, MATCHED = 16, 8    # trainer: bytes in a segment, and in what it counts
TOXIC_DOCS, ORDINARY_DOCS = 1000, 2000   # bounds of the training sample
SAMPLE_CHARS = 4096
THRESHOLDS = (2, 3, 4, 5)
HELD_OUT, FOLDS = 0, 5      # crc32 of the id modulo FOLDS: never learned from
CACHED = 1 << 19            # windows whose difference a task remembers
STRETCH = 1 << 20           # bytes of a text that are cut into windows at once

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")
COUNTED = "doc_id long, windows long, hits array<long>"


def windows(text: bytes) -> Iterator[list[bytes]]:
    """The windows of a text, in lists of about ``STRETCH`` bytes of it."""
    at, size = 0, len(text)
    while at < size:
        end = min(size, at + STRETCH)
        if end < size:                     # not inside a word
            rest = _WORD.match(text, end)
            end = rest.end() if rest else end
        words = _WORD.findall(text[at:end].translate(_LOWER))
        if any(len(w) > WIDTH for w in words):
            words = [w[k:k + WIDTH] for w in words for k in range(0, len(w), WIDTH)]
        yield words
        at = end


def all_windows(text: bytes) -> list[bytes]:
    return [w for part in windows(text) for w in part]


def _grams(word: bytes, sizes: tuple[int, ...]) -> Iterator[tuple[int, bytes]]:
    """Places and strings of these sizes in a word with separators around it."""
    b = b" " + word + b" "
    for size in sizes:
        for i in range(max(1, len(b) - size + 1)):
            yield i, b[i:i + size]


def _surprise(a: int, b: int, toxic: int, ordinary: int) -> float:
    """Log-likelihood ratio of a string that ``a`` toxic and ``b`` ordinary
    documents hold, against equal shares."""
    share = (a + b) / (toxic + ordinary)
    return 2 * sum(n * math.log(n / (share * size)) for n, size in ((a, toxic), (b, ordinary)) if n)


def distinctive(toxic: list[list[bytes]], ordinary: list[list[bytes]],
                sizes: tuple[int, ...]) -> set[bytes]:
    """Byte strings that far more toxic than ordinary documents hold."""
    def documents_with(texts):
        return Counter(g for t in texts for g in {g for w in set(t) for _, g in _grams(w, sizes)})

    a, b = documents_with(toxic), documents_with(ordinary)
    return {g for g, n in a.items() if n * len(ordinary) >= LEAST_RATIO * b[g] * len(toxic)
            and _surprise(n, b[g], len(toxic), len(ordinary)) >= SIGNIFICANT}


def stretches(word: bytes, marks: set[bytes], sizes: tuple[int, ...]) -> Iterator[bytes]:
    """The parts of a word, with the separators around it, that ``marks`` cover."""
    covered = bytearray(len(word) + 2)
    for i, g in _grams(word, sizes):
        if g in marks:
            covered[i:i + len(g)] = b"\1" * len(g)
    b = b" " + word + b" "
    for run in re.finditer(b"\1+", covered):
        yield b[run.start():run.end()]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; from samples that are too few to train on, the
    distinct samples themselves, the most frequent last."""
    samples = [s for s in samples if len(s) >= MATCHED]
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=MATCHED).as_bytes()
    except zstandard.ZstdError:
        order = sorted(Counter(samples).items(), key=lambda x: (x[1], x[0]))
        return b"".join(s for s, _ in order)[-size:]


class Distance:
    """The two dictionaries of a fit, and the difference of a window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic, ordinary

    def open(self) -> "Distance":
        def compressor(content: bytes):
            how = zstandard.ZstdCompressionParameters(
                format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
                write_checksum=False, write_dict_id=False, compression_level=3,
                strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=12, hash_log=12,
                chain_log=12, search_log=4, target_length=64)
            if not content:
                return zstandard.ZstdCompressor(compression_params=how).compress
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(compression_params=how, dict_data=raw).compress

        self._long, self._short = compressor(self.ordinary), compressor(self.toxic)
        self._known: dict[bytes, int] = {}
        return self

    def difference(self, window: bytes) -> int:
        b = (b" " + window) * COPIES + b" "
        return len(self._long(b)) - len(self._short(b))

    def counts(self, text: bytes) -> tuple[int, list[int]]:
        """Windows of a whole text, and its hits at each of ``THRESHOLDS``."""
        found: Counter = Counter()
        for words in windows(text):
            if len(self._known) > CACHED:
                self._known.clear()
            known = self._known
            for w in set(words):
                if w not in known:
                    known[w] = self.difference(w)
            found.update(map(known.__getitem__, words))
        return sum(found.values()), [sum(n for d, n in found.items() if d >= t) for t in THRESHOLDS]


def _features(windows: np.ndarray, hits: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(windows)), windows, hits])


def _trained(toxic: list[list[bytes]], ordinary: list[list[bytes]], sizes: tuple[int, ...],
             size: int) -> Distance:
    marks = distinctive(toxic, ordinary, sizes)
    apart = [b"".join(s for w in t for s in stretches(w, marks, sizes)) for t in toxic]
    whole = [b" " + b" ".join(t) + b" " for t in ordinary if t]
    return Distance(dictionary(apart, size), dictionary(whole, ORDINARY_BYTES))


def trained(toxic: list[bytes], ordinary: list[bytes]) -> Distance:
    """Dictionaries of the texts of either kind, with the best of ``SETTINGS``."""
    kinds = [[all_windows(t) for t in sorted(set(texts))] for texts in (toxic, ordinary)]
    most = [[t for i, t in enumerate(k) if i % 4] for k in kinds]
    rest = [t for k in kinds for t in k[::4]]
    label = np.array([1] * len(kinds[0][::4]) + [0] * len(kinds[1][::4]), float)
    best = None
    for sizes, size in SETTINGS:
        if not (all(most) and 0 < label.sum() < len(label)):
            best = (0.0, SETTINGS[0])
            break
        score = _trained(*most, sizes, size).open()
        counted = [score.counts(b" ".join(t)) for t in rest]
        x = _features(np.log2([n + 1 for n, _ in counted]), np.log2(np.array([h for _, h in counted]) + 1))
        loss = fit_logistic(x, np.ones(len(label)), label)[1]
        if best is None or loss < best[0]:
            best = (loss, (sizes, size))
    return _trained(*kinds, *best[1])


# -- documents and labels

def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def _for_dictionaries(doc_id: Column) -> Column:
    """Whether a label may be drawn into the sample; the others calibrate."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0


def usable_labels(labels: DataFrame) -> DataFrame:
    """One ``(doc_id, toxic)`` row per labelled id that may be learned from;
    an id with several labels is toxic if one of them says so."""
    doc_id = F.col("doc_id").cast("long")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    return (known.groupBy(doc_id.alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
            .where(_fold(F.col("doc_id")) != HELD_OUT))


def training_sample(docs: DataFrame, labels: DataFrame) -> list:
    """``(toxic, text)`` rows of the bounded sample, in a fixed order.  Ids are
    drawn from the labels alone; only the drawn documents are read out."""
    fit = labels.where(_for_dictionaries(F.col("doc_id"))).withColumn(
        "draw", F.xxhash64("doc_id", F.lit("draw")))
    # each task keeps its own first ones, and those alone are merged
    toxic, ordinary = [fit.where(F.col("toxic") == kind).orderBy("draw", "doc_id").limit(bound)
                       for kind, bound in ((1, TOXIC_DOCS), (0, ORDINARY_DOCS))]
    drawn = toxic.union(ordinary)
    start = F.pmod(F.col("draw"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1)))
    texts = (docs.where(F.col("text").isNotNull())
             .join(F.broadcast(drawn), "doc_id")      # at most TOXIC_DOCS + ORDINARY_DOCS ids
             .select("toxic", "doc_id", F.substring("text", (start + 1).cast("int"), F.lit(SAMPLE_CHARS))
                     .alias("text")))
    # rows that repeat an id are one draw
    return sorted(texts.groupBy("toxic", "doc_id").agg(F.min("text").alias("text")).collect())


def _count(distance: Distance):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = distance.open()
        for batch in batches:
            texts = batch.column(1)
            rows = [score.counts(texts[k].as_py().encode()) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in rows], pa.int64()),
                 pa.array([h for _, h in rows], pa.list_(pa.int64()))],
                names=["doc_id", "windows", "hits"])
    return run


CLASSES = 2     # classes of a count n in each doubling of n + 1


def _class(n: Column) -> Column:
    return F.round(F.log2(n + 1.0) * CLASSES) / CLASSES


def fit_logistic(x: np.ndarray, n: np.ndarray, y: np.ndarray, ridge: float = 1e-3):
    """Weights and mean loss of a logistic model of rows ``x`` that stand for
    ``n`` documents each, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (n * (y - p)) - ridge * w)
        w = w + step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-12, 1 - 1e-12)
    return w, float(-(n * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / max(1, n.sum()))


def calibrated(counted: DataFrame, labels: DataFrame) -> list[float] | None:
    """The weights of a document's classes of windows and hits, from a table of
    counts by class: its rows are the combinations of classes, however many the
    documents.  None unless both labels occur."""
    judged = counted.join(labels.where(~_for_dictionaries(F.col("doc_id"))), "doc_id")
    names = [f"h{t}" for t in THRESHOLDS]
    table = (judged.groupBy("toxic", _class(F.col("windows")).alias("w"),
                            *[_class(F.col("hits")[k]).alias(n) for k, n in enumerate(names)])
             .agg(F.count(F.lit(1)).alias("n")).collect())
    if len({r["toxic"] for r in table}) < 2:
        return None
    table.sort()
    x = _features(np.array([r["w"] for r in table]), np.array([[r[n] for n in names] for r in table]))
    n, y = (np.array([r[c] for r in table], float) for c in ("n", "toxic"))
    return [float(v) for v in fit_logistic(x, n, y)[0]]


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted, windows, hits)`` per row of
    ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``labels`` (``doc_id``, ``toxic``) are learned from where the CRC-32 of the
    id modulo 5 is not 0 (``held_out`` otherwise); a score uses the text alone.
    ``hits`` are those at each of ``THRESHOLDS``.

    * A null text counts as empty; a text without a word has no windows, and the
      score of a text of that size without hits.
    * A row with a null ``doc_id`` is scored, not learned from, not held out.
      Repeated rows get equal results.  Of several labels of an id the toxic one
      counts; labels with a null id or value don't.
    * Without labels of both kinds to calibrate on, every score is the share of
      toxic ones among the usable labels (0 if there are none).
    * An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ship_package(docs.sparkSession)
    labels = materialize(usable_labels(labels), "toxic-labels")
    sample = training_sample(docs, labels)
    distance = trained([r["text"].encode() for r in sample if r["toxic"]],
                       [r["text"].encode() for r in sample if not r["toxic"]])
    counted = materialize(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                          .mapInArrow(_count(distance), COUNTED), "toxic-windows")
    held = F.coalesce(_fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    weights = calibrated(counted, labels)
    if weights is None:
        score = F.lit(float(labels.agg(F.avg("toxic")).first()[0] or 0.0))
    else:
        z = F.lit(weights[0]) + F.lit(weights[1]) * _class(F.col("windows"))
        for k, weight in enumerate(weights[2:]):
            z = z + F.lit(weight) * _class(F.col("hits")[k])
        score = 1 / (1 + F.exp(-z))
    scored = counted.select("doc_id", held, score.alias("score"), "windows", "hits")
    return scored.select("doc_id", "held_out", "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                         "windows", "hits")
