"""Spectrum slicing against numpy's eigenvalues, and whitening against a plain
version in exact fractions."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamestats.llm.whitening import _products, above, leading, negative_pivots, whiten

TABLE = "vec_id long, embedding array<float>, label int"


def _symmetric(rng, n, values):
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    return (q * values) @ q.T


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
def test_inertia(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = rng.standard_normal((n, n))
        a = a + a.T
        assert negative_pivots(a) == (np.linalg.eigvalsh(a) < 0).sum()
    assert negative_pivots(np.zeros((n, n))) == 0
    assert negative_pivots(np.fliplr(np.eye(n))) == n // 2          # no pivot on the diagonal


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1, 0.5], [4, 4, 4, 4, 2, 1], [8, 8 - 1e-9, 8 - 2e-9, 1, 1, 1], [1e12, 1, 1e-3, 1e-3, 0, 0],
    [5, 0, 0, 0, 0, 0], [1e-9, 1e-10, 1e-11, 1e-12, 1e-13, 0], [3, 2, 2, 1, 1, 1]])
def test_leading_pairs(values):
    v = _symmetric(np.random.default_rng(4), 6, np.array(values, float))
    v = (v + v.T) / 2
    got = leading(v, 4)
    want = sorted(np.linalg.eigvalsh(v))[::-1][:4]
    norm = max(values)
    assert len(got) == sum(x > 1e-13 * norm for x in want)
    for (e, x), w in zip(got, want):
        assert abs(e - w) <= 1e-13 * norm
        assert np.linalg.norm(v @ x - e * x) <= 1e-12 * norm
    axes = np.stack([x for _, x in got])
    assert np.abs(axes @ axes.T - np.eye(len(got))).max() < 1e-10
    for number, (e, _) in enumerate(got, 1):
        assert above(v, e - 1e-12 * norm) >= number > above(v, e + 1e-12 * norm)


def test_leading_of_zero_and_of_many():
    assert leading(np.zeros((3, 3)), 4) == []
    rng = np.random.default_rng(9)
    x = rng.standard_normal((500, 64)) * np.linspace(3, 0.1, 64)
    v = np.cov(x.T, bias=True)
    w, u = np.linalg.eigh(v)
    for k, (e, y) in enumerate(leading(v, 4), 1):
        assert e == pytest.approx(w[-k], rel=1e-13) and abs(abs(y @ u[:, -k]) - 1) < 1e-12


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for most in (100, 1 << 24, 1 << 30, 1 << 52):
        y = rng.integers(-most, most, (300, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert _products(y).tolist() == want


def _plain(rows, components=4):
    rows = [(i, [int(np.floor(256.0 * float(np.float32(c)))) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in rows})
    n, size = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(size)]
    v = np.array([[float(Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit), n ** 3))
                   for j in range(size)] for i in range(size)])
    w, u = np.linalg.eigh(v)
    out = {}
    for i, x in rows:
        d = [n * x[k] - s[k] for k in range(size)]
        for c in range(1, components + 1):
            if w[-c] > 1e-12 * w[-1]:
                white = float(np.array(d, float) / n @ u[:, -c] / np.sqrt(w[-c]))
                out.setdefault((i, c, n, sum(t * t for t in d)), []).append((abs(white), w[-c] / w.sum()))
    return out


def _compare(got, rows):
    want, have = _plain(rows), {}
    for r in got:
        assert r["identity_error"] <= 1e-4
        assert int(r["deviation_exact"]) == r["deviation"]
        have.setdefault((r["vec_id"], r["component"], r["n"], r["deviation"]), []).append(
            (abs(r["whitened"]), r["explained"]))
    assert {k: len(v) for k, v in have.items()} == {k: len(v) for k, v in want.items()}
    for k, v in want.items():
        for (a, e), (b, f) in zip(sorted(have[k]), sorted(v)):
            assert a == pytest.approx(b, rel=1e-8, abs=1e-8) and e == pytest.approx(f, rel=1e-9)


def _rows(n=400, size=9):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((n, size)) * np.linspace(2, 0.2, size) + 3
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def test_equals_the_plain_version(spark):
    rows = _rows()
    rows += [(None, rows[0][1]), (7, rows[9][1]), (7, rows[7][1]), (-3, [0.0] * 9), (10 ** 12, [-0.0] * 9)]
    bad = [(900, None), (901, []), (902, [None] + [1.0] * 8), (903, [float("nan")] + [1.0] * 8),
           (904, [float("inf")] + [1.0] * 8), (905, [1.0] * 8), (906, [1.0] * 11)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], TABLE).repartition(5) \
        .withColumns({"n": F.lit(1), "x": F.lit("y"), "component": F.lit(2)})
    _compare(whiten(table).collect(), rows)


def test_signs_are_the_same_for_all_rows(spark):
    rows = _rows(60, 5)
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], TABLE).repartition(6)).collect()
    x = np.array([[np.floor(256 * c) for c in v] for _, v in rows])
    white = np.zeros((60, 4))
    for r in got:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(white.T, bias=True) - np.eye(4)).max() < 1e-9
    assert np.abs(white.mean(axis=0)).max() < 1e-9 and len(got) == 240 and len(x) == 60


@pytest.mark.parametrize("vectors, per_row", [
    ([[1.0, 2.0]] * 5, 0), ([[1.0, 2.0], [3.0, 6.0]], 1), ([[1.0], [2.0], [2.0]], 1),
    ([[float(a), float(b), 5.0] for a in range(4) for b in range(3)], 2)])
def test_fewer_dimensions(spark, vectors, per_row):
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], TABLE)).collect()
    assert len(got) == per_row * len(vectors)
    assert all(r["identity_error"] < 1e-9 for r in got)


@pytest.mark.parametrize("unit, exact, axes", [(1e9, True, 2), (1e14, False, 2), (1e300, False, 1)])
def test_large_components(spark, unit, exact, axes):
    rows = [(i, [float(i) * unit, float(i * i) * unit / 10]) for i in range(1, 30)] + [(0, [0.0, -unit])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 30 * axes and any(r["deviation"] is None for r in got)
    assert all(r["deviation_exact"] is not None for r in got) == exact
    assert all(r["identity_error"] < 1e-6 for r in got)


def test_empty_table(spark):
    none = spark.createDataFrame([], TABLE)
    assert whiten(none).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 0)], TABLE)).count() == 0


def test_query(spark):
    from gamestats.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    _compare(QUERIES["op11_embedding_whitening"](spark, sf).collect(),
             [(r["vec_id"], r["embedding"]) for r in table])
