import hashlib
import random

import numpy as np
import pytest
from llm.brute import repeated_bytes

from gamestats.llm import suffix_dedup as S


def _check(documents, rows):
    want = {}
    for i, (b, flags) in repeated_bytes(rows).items():
        kept = bytes(c for c, f in zip(b, flags) if not f)
        spans = sum(f and not (k and flags[k - 1]) for k, f in enumerate(flags))
        want[i] = (len(b), sum(flags), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in S.suffix_dedup(documents(rows)).collect()}
    assert got == want


def _texts(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    passages = ["".join(word() + " " for _ in range(rng.randrange(5, 80))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages)[rng.randrange(30):] if rng.random() < .6
                 else "".join(word() for _ in range(rng.randrange(60))) for _ in range(4)]
        rows.append((i * 3, "\n".join(parts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(documents, seed):
    _check(documents, _texts(seed))


def test_hot_anchors_are_split(documents, monkeypatch):
    monkeypatch.setattr(S, "HOT", 3)
    _check(documents, _texts(5))


def test_cases(documents):
    line = "The quick brown fox jumps over the lazy dog and runs on through the wood. "
    _check(documents, [
        (1, None), (2, ""), (3, "a" * 1000), (4, "a" * 99), (5, "a" * 100), (6, line * 4),
        (7, "x" + line * 2 + "y"), (8, "ab" * 300), (9, "é" * 120), (10, "xé" + "é" * 70),
        (11, "".join(chr(33 + (k * k) % 90) for k in range(3000))),
        (12, "q" + "".join(chr(33 + (k * k) % 90) for k in range(500, 3000)))])


def test_long_text_in_pieces(documents, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcd ") for _ in range(9000))
    monkeypatch.setattr(S, "SLICE_BYTES", 1000)
    _check(documents, [(1, text), (2, "zz" + text[2500:7000] + "q"), (3, text[100:300])])


def test_repeated_and_unnamed_rows(documents):
    a, b = "".join(chr(40 + k % 80) for k in range(0, 900, 7)), "B" * 150
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in S.suffix_dedup(
        documents([(1, a), (1, a), (2, a), (None, a)])).collect())
    assert got == [("1", len(a), 0), ("1", len(a), 0), ("2", len(a), len(a)), ("None", len(a), len(a))]


@pytest.mark.parametrize("top", [90, 2 ** 63 - 1])
def test_every_row_is_judged(documents, top):
    """Rows without an id and further texts of an id come after all others."""
    rng = random.Random(12)
    fresh = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b, c, d = (fresh(400) for _ in range(4))
    rows = [(4, a), (top, "x" + a[50:300] + "y"), (7, b), (7, c), (7, c + b[:150]), (None, d + d), (None, d),
            (None, None), (None, d), (9, a + b + c)]
    mark = {r[0]: r[1] for r in documents(rows).sparkSession.createDataFrame(
        [(t or "",) for _, t in rows], "t string").distinct().selectExpr("t", "xxhash64(t)").collect()}
    first = min((t for i, t in rows if i == 7), key=mark.get)
    stands = [r for r in rows if r[0] is not None and (r[0] != 7 or r[1] == first)]
    stray = sorted((r for r in rows if r not in stands),
                   key=lambda r: (r[0] is None, r[0] or 0, mark[r[1] or ""]))
    placed = sorted(stands) + stray
    judged = repeated_bytes([(k, t) for k, (_, t) in enumerate(placed)])
    want = sorted((str(i), len(judged[k][0]), sum(judged[k][1])) for k, (i, _) in enumerate(placed))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed)
                 for r in S.suffix_dedup(documents(rows)).collect())
    assert got == want


def test_empty_table(documents):
    assert S.suffix_dedup(documents([(1, "a")]).where("false")).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(300):
        s = rng.integers(1, rng.integers(2, 6), rng.integers(0, 50))
        assert S.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
