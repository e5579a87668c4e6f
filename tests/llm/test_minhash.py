import random

import numpy as np
from llm.brute import near_components

from gamestats.llm.minhash import BANDS, ROWS, band_keys, near_dedup, signature
from gamestats.llm.shingles import shingle_sets


def _check(documents, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(documents(rows)).collect()}
    want = {i: (n, c, c == i) for i, (n, c) in near_components(rows).items()}
    assert got == want


def test_cases(documents):
    base = " ".join(f"w{i}" for i in range(60))
    _check(documents, [
        (5, base), (3, base.upper()), (9, base + " tail"), (1, None), (2, ""), (4, " \t\n"),
        (6, "one two"), (7, "ONE  two"), (8, "one"), (10, "a b c d e"), (11, "a b c d e f"),
        (12, "no break is a word char"), (13, " ".join(f"v{i}" for i in range(30_000)))])


def test_chains_and_far_copies(documents):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    words = base
    for i in range(1, 12):                      # a chain: each close to the one before
        words = list(words)
        words[rng.randrange(120)] = f"c{i}"
        rows.append((i, " ".join(words)))
    for i in range(20, 80):                     # copies of the base, near and far
        copy = list(base)
        for _ in range(rng.randrange(1, 8)):
            copy[rng.randrange(120)] = f"f{i}_{rng.random()}"
        rows.append((i, " ".join(copy)))
    for i in range(100, 140):                   # shortened copies that miss the same part
        rows.append((i, " ".join(base[:60 + i % 3]) + f" x{i}"))
    rng.shuffle(rows)
    _check(documents, rows)


def test_repeated_and_unnamed_rows(documents):
    text = " ".join(f"w{i}" for i in range(40))
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup(
        documents([(2, text), (2, text), (3, text), (None, text)])).collect())
    assert got == [("2", "2", True), ("2", "2", True), ("3", "2", False), ("None", "None", True)]


def test_one_id_with_different_texts_joins_their_groups(documents):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup(documents(
        [(9, x), (9, y), (9, y), (9, ""), (4, x), (5, y + " tail"), (6, z), (7, z + " more"), (8, None)])).collect())
    assert got == [(4, 4, True), (5, 4, False), (6, 6, True), (7, 6, False), (8, 8, True)] + 4 * [(9, 4, False)]


def test_a_row_repeated_many_times_is_compared_once(documents, monkeypatch):
    from gamestats.llm import minhash

    base = " ".join(f"w{i}" for i in range(40))
    rows = [(3, base)] * 200 + [(k, base + f" t{k}") for k in (1, 2, 7)]
    made = []
    confirm = minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda sets, pairs: made.append(
        confirm(sets, pairs).count()) or confirm(sets, pairs))
    got = {(r.doc_id, r.component_id) for r in near_dedup(documents(rows)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 1)} and sum(made) <= 6


def test_empty_table(documents):
    assert near_dedup(documents([(1, "a")]).where("false")).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2 ** 63, 100).astype(np.uint64)])
    same = (signature(a) == signature(b)).mean()
    assert abs(same - 300 / 500) < 0.15
    assert len(band_keys(signature(a))) == BANDS and BANDS * ROWS == len(signature(a))


def test_shingles_of_a_batch_equal_those_of_single_texts():
    texts = [b"", b"a b c d e f g", b"  A B\tc", b"x" * 1000, b"\x0b\x0c", "é ü ñ ß ô".encode()]
    alone = [shingle_sets([t])[0] for t in texts]
    for x, y in zip(alone, shingle_sets(texts)):
        assert (x == y).all() and len(x) == len(y)


def test_far_copies_in_the_buckets_of_a_large_group(documents, monkeypatch):
    """Near copies of one text, and copies further from it that each lie within
    the threshold of one another or of a few near ones only: nothing is lost,
    and far fewer pairs are compared than lie across components."""
    from gamestats.llm import minhash

    rng = random.Random(8)
    base = [f"b{i}" for i in range(150)]

    def changed(words, places, tag):
        out = list(words)
        for at in places:
            out[at] = f"{tag}_{at}"
        return out

    rows = [(i, " ".join(changed(base, [rng.randrange(150)], f"n{i}"))) for i in range(150)]
    for k in range(30):                       # far: one to three changed places, five shingles each
        far = changed(base, rng.sample(range(10, 140), 6), f"f{k}")
        rows.append((500 + 2 * k, " ".join(far)))
        rows.append((501 + 2 * k, " ".join(changed(far, [rng.randrange(150)], f"g{k}"))))
    compared = []
    confirm = minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda sets, pairs: compared.append(pairs.count()) or confirm(sets, pairs))
    _check(documents, rows)
    assert sum(compared) < 0.2 * len(rows) ** 2 / 2


def test_block_counts_bound_the_intersection(spark):
    import pyarrow as pa

    from gamestats.llm.minhash import BLOCKS, _block_counts
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(-2 ** 40, 2 ** 40, n)) for n in (5, 300, 40_000)]
    own = [None, sets[1][:100], sets[2][::2]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array(list(sets), pa.list_(pa.int64())),
         pa.array(own, pa.list_(pa.int64()))], names=["doc_id", "s1", "shingles", "own"])
    (out,) = _block_counts(iter([batch]))
    for k, counts in enumerate(out.column(2).to_pylist()):
        left = set(sets[k].tolist()) - set([] if own[k] is None else own[k].tolist())
        assert counts == [sum(1 for x in left if x % BLOCKS == g) for g in range(BLOCKS)]
