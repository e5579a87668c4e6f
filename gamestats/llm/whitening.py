"""Embedding whitening by spectrum slicing.

Every vector component becomes an integer, so the sums that the covariance is
made of are exact, whatever the order in which they are added.  The covariance
has as many rows as a vector has components: it is put together on the driver,
and only it.  Its leading eigenvalues are isolated by counting: the number of
negative pivots of the LDLᵀ factors of ``V - s I`` is the number of eigenvalues
below ``s``.  Bisection on that count shrinks an interval until it holds one
eigenvalue (or a cluster that double precision can't part), Rayleigh quotient
iteration converges inside it, and two more counts certify the eigenvalue's
number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import materialize, ship_package

SCALE = 256
COMPONENTS = 4
EPS = float(np.finfo(float).eps)
_PIVOT = (1 + 17 ** 0.5) / 8      # bound on growth of the factors' entries
EXACT = 1 << 53                   # integers below are exact in double precision

HALF = 1 << 60                    # sums travel in two parts, so that none overflows
SUMS = "i int, j int, high decimal(38,0), low decimal(38,0)"
WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, "
            "explained double, identity_error double, deviation_exact decimal(38,0)")


# -- inertia and eigenpairs of one symmetric matrix

def negative_pivots(a: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix, from its LDLᵀ factors with
    complete diagonal pivoting: D has blocks of one row, or of two with one
    eigenvalue on either side of 0."""
    a = a.copy()
    n, at, negative = len(a), 0, 0
    tiny = EPS * max(1e-300, float(np.abs(a).max(initial=0.0)))

    def swap(p: int, q: int) -> None:
        if p != q:
            a[[p, q]] = a[[q, p]]
            a[:, [p, q]] = a[:, [q, p]]

    while at < n:
        rest = a[at:, at:]
        diagonal = np.abs(np.diagonal(rest))
        p = int(diagonal.argmax())
        off = np.abs(rest - np.diag(np.diagonal(rest)))
        k = int(off.argmax())
        q, r = divmod(k, n - at)
        if max(diagonal[p], off[q, r]) <= tiny * EPS:
            break                                   # the rest is zero: no sign
        if diagonal[p] >= _PIVOT * off[q, r]:
            swap(at, at + p)
            d = a[at, at]
            negative += d < 0
            column = a[at + 1:, at].copy()
            a[at + 1:, at + 1:] -= np.outer(column, column / d)
            at += 1
        else:
            low, high = sorted((q, r))
            swap(at, at + low)
            swap(at + 1, at + high)
            block = a[at:at + 2, at:at + 2]
            negative += 1                           # a block of two is indefinite
            two = a[at + 2:, at:at + 2].copy()
            a[at + 2:, at + 2:] -= two @ np.linalg.solve(block, two.T)
            at += 2
    return negative


def above(v: np.ndarray, s: float) -> int:
    """Eigenvalues of ``v`` that are larger than ``s``."""
    return negative_pivots(s * np.eye(len(v)) - v)


def _against(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for f in found:
            x = x - (f @ x) * f
    return x


def _iterate(v: np.ndarray, low: float, high: float, found: list[np.ndarray], norm: float, seed: int):
    """Rayleigh quotient iteration from inverse iteration at the middle of an
    interval: the pair, or None where it leaves the interval."""
    x = _against(np.random.default_rng(seed).standard_normal(len(v)), found)
    x /= np.linalg.norm(x)
    shift, best = (low + high) / 2, None
    for turn in range(40):
        shifted = v - shift * np.eye(len(v))
        try:
            y = np.linalg.solve(shifted, x)
        except np.linalg.LinAlgError:               # the shift is an eigenvalue
            y = np.linalg.solve(shifted + 4 * EPS * norm * np.eye(len(v)), x)
        y = _against(y, found)
        size = np.linalg.norm(y)
        if not np.isfinite(size) or size == 0:
            break
        x = y / size
        value = float(x @ v @ x)
        residual = float(np.linalg.norm(_against(v @ x - value * x, found)))
        if best is None or residual < best[2]:
            best = (value, x, residual)
        elif turn > 2:
            break                                   # rounding is reached
        if turn >= 1:                               # the first turns settle the direction
            if not low - 8 * EPS * norm <= value <= high + 8 * EPS * norm:
                return None
            shift = value
    return best


def leading(v: np.ndarray, count: int) -> list[tuple[float, np.ndarray]]:
    """The largest eigenvalues of a symmetric positive semidefinite matrix with
    unit eigenvectors, by falling value: at most ``count``, and only those that
    differ from 0 by more than rounding."""
    norm = float(np.abs(v).sum(axis=1).max(initial=0.0))   # no eigenvalue is larger
    floor, least = 4 * len(v) * EPS * norm, 64 * EPS * norm
    found: list[tuple[float, np.ndarray]] = []
    if norm == 0:
        return found
    counts: dict[float, int] = {}

    def larger(s: float) -> int:
        if s not in counts:
            counts[s] = above(v, s)
        return counts[s]

    rank = larger(floor)
    for number in range(1, min(count, rank) + 1):
        low, high = floor, norm * (1 + 8 * EPS)
        for s in sorted(counts):                    # what earlier counts say
            if larger(s) >= number:
                low = max(low, s)
            else:
                high = min(high, s)
        pair = None
        while pair is None:
            alone = larger(low) == number and larger(high) == number - 1
            if alone or high - low <= least:
                pair = _iterate(v, low, high, [x for _, x in found], norm, number)
                if pair is not None:
                    slack = max(least, 4 * pair[2])
                    if not (larger(pair[0] - slack) >= number and larger(pair[0] + slack) < number):
                        pair = None                 # the counts don't confirm its number
                if pair is None and high - low <= least:
                    raise ArithmeticError("eigenvalue not certified")
            if pair is None:
                middle = (low + high) / 2
                low, high = (middle, high) if larger(middle) >= number else (low, middle)
        found.append(pair[:2])
    return found


# -- exact sums over a table of integer vectors

def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _products(y: np.ndarray) -> np.ndarray:
    """``yᵀ y`` of integers, exact, as Python integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most >= EXACT:
        y = y.astype(object)
        return y.T @ y
    rows = max(1, EXACT // max(1, most * most))     # so many products stay exact
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), rows):
        part = y[at:at + rows].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _emit(i: np.ndarray, j: np.ndarray, s: list[int]) -> pa.RecordBatch:
    parts = [divmod(int(v), HALF) for v in s]
    high, low = (pa.array([Decimal(p[k]) for p in parts], pa.decimal128(38, 0)) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), high, low],
                                      names=["i", "j", "high", "low"])


def _sums(size: int):
    """Per task: the number of rows (``i`` -1) and the sum of each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            n += len(x)
            most = int(np.abs(x).max(initial=0))
            if len(x) and most < (1 << 62) // len(x):
                total += x.sum(axis=0).astype(object)
            else:
                total += x.astype(object).sum(axis=0) if len(x) else 0
        yield _emit(np.arange(-1, size), np.zeros(size + 1, int), [n, *total])
    return run


def _moments(size: int, centre: list[int]):
    """Per task: sums of products of the centred components, ``i <= j``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        middle = np.array(centre, object)
        if all(abs(c) < 1 << 61 for c in centre):
            middle = middle.astype(np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            wide = middle.dtype == object or int(np.abs(x).max(initial=0)) >= 1 << 61
            total += _products(x.astype(object) - middle if wide else x - middle)
        i, j = np.triu_indices(size)
        yield _emit(i, j, list(total[i, j]))
    return run


def covariance(fit: DataFrame, size: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and covariance (divisor: rows) of a written table of distinct
    vectors ``x``.  What comes to the driver has ``size`` squared entries."""
    def collected(run) -> dict:
        rows = fit.select("x").mapInArrow(run, SUMS).groupBy("i", "j").agg(
            F.sum("high").alias("high"), F.sum("low").alias("low"))
        return {(r["i"], r["j"]): int(r["high"]) * HALF + int(r["low"]) for r in rows.collect()}

    got = collected(_sums(size))
    n, s = got.get((-1, 0), 0), [got.get((i, 0), 0) for i in range(size)]
    if n == 0:
        return 0, s, np.zeros((size, size))
    # centred on the integers next to the means: what is left of them is r / n
    centre = [(2 * t + n) // (2 * n) for t in s]
    r = [t - n * c for t, c in zip(s, centre)]
    got = collected(_moments(size, centre))
    v = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            v[i, j] = v[j, i] = (got[i, j] * n - r[i] * r[j]) / (n * n)
    return n, s, v


def _deviations(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """``n x - S``, exact: as 64-bit integers where they fit, else Python's."""
    most = max([int(np.abs(x).max(initial=0)) * n, *map(abs, s), 1])
    if most < 1 << 61:
        return x * n - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def _whiten(d: np.ndarray, n: int, vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (d.astype(float) / n) @ vectors.T / np.sqrt(values)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact)`` per usable row of ``vectors`` and leading component.

    A component c of a vector counts as the integer floor(scale * c).  The
    covariance is that of the distinct integer vectors, ``n`` of them; a row is
    projected on its unit eigenvectors, numbered from 1 by falling eigenvalue,
    and divided by the eigenvalue's root.

    * Rows whose vector is null, empty, or holds null or non-finite components
      take no part.  Vectors of several lengths can't be compared: those of the
      commonest length (the longest of equally common ones) take part.
    * Every row is its own: those with a null or repeated id, and those with
      equal vectors, each get their rows; equal vectors count once in the fit.
    * Eigenvalues that are 0 but for rounding give no component, so vectors that
      span fewer dimensions, or fewer vectors, have fewer than ``components``,
      and a single distinct vector has none.  Components of equal eigenvalues
      are an orthonormal basis of their space, the same for all rows.
    * ``scale * c`` beyond a long counts as the nearest long.
    * ``deviation`` is null where it doesn't fit a long; ``deviation_exact``
      then still holds it (null beyond 38 digits).
    * An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)

    def good(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                            F.col(vector_col).cast("array<double>").alias("v")) \
        .where(F.col("v").isNotNull() & (F.size("v") > 0)) \
        .where(F.forall("v", good))
    rows = materialize(usable.select(
        "vec_id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x")), "vectors")
    empty = spark.createDataFrame([], WHITENED)
    common = (rows.groupBy(F.size("x").alias("size")).count()
              .orderBy(F.col("count").desc(), F.col("size").desc()).first())
    if common is None:
        return empty
    size = common["size"]
    rows = rows.where(F.size("x") == size)
    fit = materialize(rows.select("x").distinct(), "distinct-vectors")
    n, s, v = covariance(fit, size)
    pairs = leading(v, components)
    if not pairs:
        return empty
    values = np.array([e for e, _ in pairs])
    axes = np.stack([x for _, x in pairs])
    trace, k = float(np.trace(v)), len(pairs)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = _whiten(_deviations(_matrix(batch.column(0), size), n, s), n, axes, values)
            yield pa.RecordBatch.from_arrays(list(w.T), names=[f"w{i}" for i in range(k)])

    # the whitened fit list: its means, then products of what is left of them
    whitened = fit.select("x").mapInArrow(projected, ", ".join(f"w{i} double" for i in range(k)))
    means = whitened.agg(*[F.avg(f"w{i}").alias(f"m{i}") for i in range(k)]).first()
    error = max(abs(value - (i == j)) for (i, j), value in zip(
        [(i, j) for i in range(k) for j in range(i, k)],
        whitened.agg(*[F.avg((F.col(f"w{i}") - means[i]) * (F.col(f"w{j}") - means[j]))
                       for i in range(k) for j in range(i, k)]).first()))

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0), _matrix(batch.column(1), size)
            d = _deviations(x, n, s)
            if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * size >= 1 << 63:
                d = d.astype(object)
            exact = [int(t) for t in (d * d).sum(axis=1)]
            w = _whiten(d, n, axes, values)
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n)),
                 pa.array([t if t < 1 << 63 else None for t in exact for _ in range(k)], pa.int64()),
                 pa.array(w.ravel()), pa.array(np.tile(values / trace, m)),
                 pa.array(np.full(m * k, error)),
                 pa.array([Decimal(t) if t < 10 ** 38 else None for t in exact for _ in range(k)],
                          pa.decimal128(38, 0))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error", "deviation_exact"])

    return rows.select("vec_id", "x").mapInArrow(result, WHITENED)
