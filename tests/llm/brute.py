"""Plain-Python versions of the corpus operators, for small tables."""

import re
from collections import Counter

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in sorted(sets.items()):
        for j, n in Counter(j for x in s for j in index.get(x, ())).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            index.setdefault(x, []).append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeated_bytes(rows, length=100):
    """doc_id -> list of covered flags."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        flags = [False] * len(b)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                flags[p:p + length] = [True] * length
            seen.add(w)
        out[i] = (b, flags)
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def removed_lines(rows, threshold=2, least=40):
    """(doc_id, pos) of removed lines."""
    place, lines = {}, []
    for i, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            if re.search(r"[^ \t\n\x0b\f\r]", line):
                lines.append((i, k, line))
                place.setdefault(line, (i, k))
    near = set()
    for s, at in place.items():
        if len(s.encode()) < least:
            continue
        for r, other in place.items():
            if (other < at and len(r.encode()) >= least
                    and abs(len(r.encode()) - len(s.encode())) <= threshold
                    and edit_distance(r.encode(), s.encode()) <= threshold):
                near.add(s)
                break
    return {(i, k) for i, k, line in lines if line in near or place[line] != (i, k)}, near
