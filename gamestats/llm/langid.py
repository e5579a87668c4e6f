"""Language identification with a bidirectional gated recurrent network over
bytes.

A text is cut into windows of ``WINDOW`` bytes; in each of them one gated
recurrent layer reads forwards and one backwards, and a softmax over both
states gives every position a language distribution.  The distribution of a
document is the mean over all positions of its whole text.

The network is trained here, in numpy, by backpropagation through time, on a
bounded sample: up to ``DOCS_PER_LANGUAGE`` labelled documents of each
language, by hash of the id, of each a stretch of ``SAMPLE_CHARS`` characters
at a place given by the same hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamestats.llm.common import ship_package

WINDOW = 64
HIDDEN = 8                 # units in each direction
DOCS_PER_LANGUAGE = 200    # bound of the training sample
SAMPLE_CHARS = 4096
STEPS = 260
BATCH = 128                # windows in a training step
RATE = 0.02
AT_ONCE = 2048             # windows in a prediction step
UNKNOWN = "und"
HELD_OUT, FOLDS = 1, 3     # crc32 of the id modulo FOLDS: never learned from
LEAST_JUDGED = 256         # bytes; shorter texts are never rejected by their score
LEAD = 0.15                # least share of the way from chance to certainty
_PAD = 0

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into windows: bytes ``(n, size)``, the number of real
    bytes of each window, and the text it belongs to.  An empty text has none."""
    counts = [-(-len(t) // size) for t in texts]
    data = np.frombuffer(b"".join(t.ljust(c * size, bytes([_PAD]))
                                  for t, c in zip(texts, counts)), np.uint8).reshape(-1, size)
    owner = np.repeat(np.arange(len(texts)), counts)
    real = np.full(len(owner), size)
    for k, (t, c) in enumerate(zip(texts, np.cumsum(counts))):
        if t and len(t) % size:
            real[c - 1] = len(t) % size
    return data, real, owner


class Network:
    """Weights of both directions: ``x`` (a row per byte: update, reset and
    candidate inputs), ``h`` (recurrent) and the output layer ``v``, ``c``."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden

        def some(*shape):
            return (rng.standard_normal(shape) * 0.3).astype(np.float32)

        self.weights = {
            "xf": some(256, 3 * hidden), "hf": some(hidden, 3 * hidden),
            "xb": some(256, 3 * hidden), "hb": some(hidden, 3 * hidden),
            "v": some(2 * hidden, len(languages)),
            "c": np.zeros(len(languages), np.float32)}

    def _layer(self, data: np.ndarray, way: str, keep: bool):
        """States of one direction for windows ``data`` (time, batch)."""
        x, u, n = self.weights["x" + way], self.weights["h" + way], self.hidden
        steps, batch = data.shape
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        state = np.zeros((batch, n), np.float32)
        states = np.empty((steps, batch, n), np.float32)
        kept = {}
        for t in order:
            g = x[data[t]]
            r = state @ u
            gates = g[:, :2 * n] + r[:, :2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1.0
            gates *= 0.5                                    # logistic function
            z, reset = gates[:, :n], gates[:, n:]
            new = reset * r[:, 2 * n:]
            new += g[:, 2 * n:]
            np.tanh(new, out=new)
            if keep:
                kept[t] = (state, z, reset, new, r[:, 2 * n:])
            state = state - new
            state *= z
            state += new
            states[t] = state
        return states, kept

    def _output(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        v, n = self.weights["v"], self.hidden
        p = forward @ v[:n]
        p += backward @ v[n:]
        p += self.weights["c"]
        p -= p.max(axis=-1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=-1, keepdims=True)
        return p

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Language distribution at every position: (time, batch, language)."""
        forward, _ = self._layer(data, "f", False)
        backward, _ = self._layer(data, "b", False)
        return self._output(forward, backward)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text; zeros if empty."""
        data, real, owner = windows(texts)
        out = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(data), AT_ONCE):
            part = np.ascontiguousarray(data[at:at + AT_ONCE].T)
            p = self.positions(part)
            p[np.arange(WINDOW)[:, None] >= real[None, at:at + AT_ONCE]] = 0
            np.add.at(out, owner[at:at + AT_ONCE], p.sum(axis=0))
        return out / np.maximum([[len(t)] for t in texts], 1)

    # -- training

    def _back(self, data: np.ndarray, way: str, kept: dict, above: np.ndarray, grads: dict) -> None:
        """Backpropagation through time of one direction; ``above`` is the
        gradient that each state gets from the output layer."""
        u, n = self.weights["h" + way], self.hidden
        steps = data.shape[0]
        order = range(steps - 1, -1, -1) if way == "f" else range(steps)
        carry = np.zeros_like(above[0])
        du = np.zeros_like(u)
        dx = np.zeros((steps, data.shape[1], 3 * n), np.float32)
        for t in order:
            before, z, reset, new, ru = kept[t]
            d = above[t] + carry
            dnew = d * (1 - z) * (1 - new * new)
            dg = dx[t]
            dg[:, :n] = d * (before - new) * z * (1 - z)
            dg[:, n:2 * n] = dnew * ru * reset * (1 - reset)
            dg[:, 2 * n:] = dnew
            dr = dg.copy()
            dr[:, 2 * n:] *= reset
            du += before.T @ dr
            carry = d * z + dr @ u.T
        table = np.zeros_like(self.weights["x" + way])
        np.add.at(table, data.ravel(), dx.reshape(-1, 3 * n))
        grads["x" + way], grads["h" + way] = table, du

    def step(self, data: np.ndarray, real: np.ndarray, label: np.ndarray) -> dict:
        """Gradients of the mean cross-entropy over all real positions."""
        v, n = self.weights["v"], self.hidden
        forward, kf = self._layer(data, "f", True)
        backward, kb = self._layer(data, "b", True)
        p = self._output(forward, backward)
        p[:, np.arange(len(label)), label] -= 1
        p[np.arange(len(data))[:, None] >= real[None, :]] = 0
        p /= max(1, real.sum())
        grads: dict = {"c": p.sum(axis=(0, 1)),
                       "v": np.concatenate([np.einsum("tbh,tbl->hl", forward, p),
                                            np.einsum("tbh,tbl->hl", backward, p)])}
        self._back(data, "f", kf, p @ v[:n].T, grads)
        self._back(data, "b", kb, p @ v[n:].T, grads)
        return grads


def train(texts: list[bytes], labels: list[str], seed: int = 5, steps: int = STEPS) -> Network:
    """Fit a network on labelled texts; each step draws windows of all
    languages alike."""
    languages = sorted(set(labels))
    net = Network(languages)
    data, real, owner = windows(texts)
    label = np.array([languages.index(x) for x in labels], np.int64)[owner]
    by_language = [np.flatnonzero(label == k) for k in range(len(languages))]
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(w) for k, w in net.weights.items()}
    second = {k: np.zeros_like(w) for k, w in net.weights.items()}
    for i in range(1, steps + 1):
        draw = rng.integers(0, len(languages), BATCH)
        rows = np.array([rng.choice(by_language[k]) for k in draw])
        grads = net.step(np.ascontiguousarray(data[rows].T), real[rows], label[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, i / 20) * (1 - 0.9 * i / steps)
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.weights[k] -= (rate * (first[k] / (1 - 0.9 ** i))
                               / (np.sqrt(second[k] / (1 - 0.999 ** i)) + 1e-8)).astype(np.float32)
    return net


def training_sample(docs: DataFrame) -> list:
    """``(lang, text)`` rows of the bounded sample, in a fixed order."""
    draw = F.xxhash64("doc_id")
    start = F.pmod(draw, F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1)))
    first = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    usable = docs.where((F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
                        & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    return sorted(usable.select(
        "lang", "doc_id", draw.alias("draw"),
        F.substring("text", (start + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
        .withColumn("turn", F.row_number().over(first))
        .where(F.col("turn") <= DOCS_PER_LANGUAGE).select("lang", "turn", "text").collect())


def _labels(net: Network | None, lettered, texts) -> tuple[list[str], list[float]]:
    """Language and score of the texts of a batch."""
    known = [k for k, yes in enumerate(lettered.to_pylist()) if yes and net is not None]
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    for at in _cuts(known, texts):
        p = net.pooled([texts[k].as_py().encode() for k in at])
        for k, row in zip(at, p):
            best = int(row.argmax())
            lang[k], score[k] = net.languages[best], float(min(1.0, row[best]))
    return lang, score


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, lettered, texts = (batch.column(c) for c in range(4))
            lang, score = _labels(net, lettered, texts)
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def _cuts(rows: list[int], texts, size: int = 1 << 20) -> Iterator[list[int]]:
    part, n = [], 0
    for k in rows:
        part.append(k)
        n += len(texts[k].as_buffer())
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def fitted(docs: DataFrame) -> Network | None:
    """The network trained on the labelled sample of ``docs``; None without one."""
    ship_package(docs.sparkSession)
    sample = training_sample(docs)
    return (train([r["text"].encode() for r in sample], [r["lang"] for r in sample])
            if sample else None)


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row of ``docs`` (``doc_id``,
    ``text``, ``lang``; other columns are ignored).

    ``lang`` is learned from where it is not null and the id's CRC-32 modulo 3
    is not 1 (``held_out`` otherwise); predictions use the text alone.  A text
    that is null or has no letter is ``und`` with score 0, and so is every
    text when there is nothing to learn from.  A row with a null ``doc_id`` is
    predicted, not learned from, and not held out.  Repeated rows get equal
    results; ties go to the first language in code-point order.  An empty
    table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    net = fitted(docs)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), lettered.alias("lettered"), "text") \
        .mapInArrow(_predict(net), PREDICTED)


def told(net: Network, n_bytes: int, score: float) -> bool:
    """Whether the pooled score tells the language of a text: it is at least
    ``LEAD`` of the way from chance (a share of ``1 / languages`` each) to 1.
    Texts under ``LEAST_JUDGED`` bytes have too few positions to be judged."""
    chance = 1 / len(net.languages)
    return n_bytes < LEAST_JUDGED or chance == 1 or score >= chance + LEAD * (1 - chance)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that have a letter and a language
    that can be told (``told``): a long text of which no language holds clearly
    more than its chance share goes.  When there was nothing to learn from,
    all rows with a letter stay."""
    net = fitted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).flatten()
            names = [f.name for f in batch.schema.field(0).type]
            texts, keep = rows[names.index("text")], batch.column(1).to_pylist()
            if net is not None:
                lang, score = _labels(net, batch.column(1), texts)
                keep = [x != UNKNOWN and told(net, len(texts[k].as_buffer()), score[k])
                        for k, x in enumerate(lang)]
            whole = pa.RecordBatch.from_arrays(rows, names=names)
            yield whole.filter(pa.array(keep, pa.bool_()))

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       lettered.alias("lettered")).mapInArrow(run, docs.schema)
