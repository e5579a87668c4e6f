"""Vectorised word shingles: whole batches of texts at once, in numpy.

A word is a maximal run of bytes other than space and 09-0D, with A-Z
lower-cased; every run of ``WORDS`` consecutive words is one shingle, and a
text with fewer words has its whole word sequence as one.  Words and shingles
are 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
SLICE_BYTES = 4 << 20

_U = np.uint64
_rng = np.random.default_rng(20240501)
BYTE = _rng.integers(1, 2 ** 64, 256, dtype=_U)
_BYTE = BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]                       # A-Z counts as a-z
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_PLACE = _rng.integers(1, 2 ** 64, WORDS, dtype=_U) | _U(1)
_BASE = int(_rng.integers(1, 2 ** 63)) * 2 + 1
_BASE_INVERSE = pow(_BASE, -1, 2 ** 64)
_powers: list[tuple[np.ndarray, np.ndarray]] = []   # one pair, replaced when it is too short


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of them."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, _U(base & (2 ** 64 - 1)), _U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = [(out[0], out[1])]
    return _powers[0]


def _word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and fingerprint of each word; ``buf`` ends with a separator."""
    gap = _SEPARATOR[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    power, inverse = power_tables(len(buf))
    run = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE[buf] * power[:len(buf)], out=run[1:])
    return start, mix((run[end] - run[start]) * inverse[start] + (end - start).astype(_U))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text."""
    if not texts:
        return []
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    start, word = _word_hashes(buf)
    first = np.searchsorted(start, bounds)            # first word of each text
    n = len(word)
    full = np.zeros(n, _U)
    for i in range(min(WORDS, n)):
        full[:n - i] += word[i:] * _PLACE[i]
    full = mix(full + _U(WORDS))
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            out.append(np.unique(full[a:b - WORDS + 1]))
        elif b > a:
            few = (word[a:b] * _PLACE[:b - a]).sum(dtype=_U) + _U(b - a)
            out.append(mix(np.array([few], _U)))
        else:
            out.append(np.empty(0, _U))
    return out


def slices(rows: Iterable[tuple], size: int = SLICE_BYTES) -> Iterator[list[tuple]]:
    """Cut ``(key, text bytes)`` rows into lists of about ``size`` bytes."""
    part, n = [], 0
    for row in rows:
        part.append(row)
        n += len(row[1])
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part
