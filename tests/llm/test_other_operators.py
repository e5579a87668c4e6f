import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamestats.llm import covertree
from gamestats.llm.covertree import top_k_search
from gamestats.llm.langid import identify, keep_identified
from gamestats.llm.mixing import mix
from gamestats.llm.packing import best_fit, best_fit_packing, crossover, default_tokenizer, evolve
from gamestats.llm.warc import round_trip

DOCS = [(i, " ".join(f"w{i}x{k}" for k in range(i % 13)), "en", "abc"[i % 3]) for i in range(40)]
ODD = [(None, "no id here", "en", "a"), (None, None, None, None), (50, None, "en", None), (51, "", "en", None),
       (52, "same text", "en", "a"), (52, "same text", "en", "a"), (53, "long " * 3000, "en", "b")]


def test_mix(documents):
    rows = documents(DOCS + ODD)
    got = mix(rows).collect()
    assert len(got) == len(DOCS) + len(ODD)
    assert sorted(map(str, got)) == sorted(map(str, mix(rows).collect()))       # reruns agree
    taken, largest, target = {}, {}, {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-9
    for source, want in target.items():
        assert abs(taken[source] - want) <= largest[source] + 1e-6
    total = sum(r["size"] for r in got)
    room = sum(2 * size for size in {r["source"]: r["source_size"] for r in got}.values())
    assert sum(target.values()) == pytest.approx(min(1.5 * total, room))
    assert mix(rows.where("false")).count() == 0


def test_packing(documents):
    from tokenizers import Tokenizer

    rows = DOCS + ODD
    got = best_fit_packing(documents(rows)).collect()
    encode = Tokenizer.from_file(default_tokenizer()).encode
    want = {}
    for i, text, *_ in rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = b"".join(x.to_bytes(4, "little") for x in ids[a:b])
            key = (i, piece, a, b - a, zlib.crc32(part))
            want[key] = want.get(key, 0) + 1
    have, sequences = {}, {}
    for r in got:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        have[key] = have.get(key, 0) + 1
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert have == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(r["length"] for r in got) / 2048) + 1
    assert best_fit_packing(documents(rows).where("false")).count() == 0


def test_search_where_no_bin_is_nearly_full():
    rng = random.Random(3)
    size = []
    for _ in range(300):                       # three to a bin of 1960
        a = rng.randrange(560, 820)
        b = rng.randrange(560, 1960 - a - 480)
        size += [a, b, 1960 - a - b]
    falling = best_fit(sorted(range(900), key=lambda i: -size[i]), size, [], 2048)
    first = [x for x in falling if sum(size[i] for i in x) < 0.985 * 2048]
    items = sorted(i for x in first for i in x)
    other = best_fit(items, size, [], 2048)
    poor = [x for x in other if sum(size[i] for i in x) < 0.985 * 2048]
    assert poor and not {tuple(sorted(x)) for x in crossover(first, poor, size, 2048, np.random.default_rng(1))} \
        <= {tuple(sorted(x)) for x in first}
    best = evolve(size, evolve(size, None, 1), 2)
    assert len(set(best)) < len(falling)
    fill = {}
    for n, k in zip(size, best):
        fill[k] = fill.get(k, 0) + n
    assert max(fill.values()) <= 2048


def test_top_k(spark):
    vectors = [(i, [((i * k * 37) % 101 - 50) / 50 for k in range(1, 9)]) for i in range(300)]
    odd = [(300, None), (350, [None] + [0.5] * 7), (400, [float("nan")] + [0.5] * 7)]
    df = spark.createDataFrame([(*v, 1) for v in vectors + odd],
                               "vec_id long, embedding array<double>, rank int").repartition(4)
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    want = []
    for q in range(0, 300, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i)
                        for i, v in whole.items() if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    got = top_k_search(df).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == want
    assert top_k_search(df.where("false")).count() == 0
    assert top_k_search(df.where("vec_id = 50")).count() == 0          # no other row


def _brute_top_k(rows, every=50, k=5):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for at, (q, v) in enumerate(whole):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i)
                            for n, (i, w) in enumerate(whole) if n != at)[:k]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(want)


def test_top_k_keeps_rows_that_repeat_an_id(spark):
    rng = random.Random(4)
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [0.5, 0.0]), (8, [0.5, 0.0]), (50, [0.0, 1.0]),
            (50, [0.0, 1.0]), (50, [1.0, 1.0])]
    rows += [(rng.randrange(60, 90), [rng.randrange(-4, 5) / 4, rng.randrange(-4, 5) / 4]) for _ in range(80)]
    odd = [(100, [float("inf"), 0.0]), (101, [float("-inf"), 0.0]), (None, [9.0, 9.0]), (150, [None, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(map(tuple, top_k_search(df).collect())) == _brute_top_k(rows)


def test_top_k_of_vectors_of_several_lengths(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, [1.0, 0.5, 4.0]), (50, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    padded = [(i, (v + [0.0] * 3)[:3]) for i, v in rows]
    assert sorted(map(tuple, top_k_search(df).collect())) == _brute_top_k(padded)


def test_top_k_over_several_groups_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(covertree, "GROUP", 4)
    monkeypatch.setattr(covertree, "CHUNK", 40)
    monkeypatch.setattr(covertree, "CELLS", 3)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert sorted(map(tuple, top_k_search(df, every=10).collect())) == _brute_top_k(rows, 10)


def test_search_prunes_clustered_vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 400, (24, 6))
    data = np.floor(centres[rng.integers(0, 24, 3000)] + rng.normal(0, 6, (3000, 6))).astype(np.int64)
    asked = np.arange(0, 3000, 50)
    top = covertree.dual_search(data[asked], asked, np.full(len(asked), -np.inf), data, np.arange(3000), 5)
    assert top.products < len(asked) * len(data) / 2
    scores = data[asked] @ data.T
    scores[np.arange(len(asked)), asked] = -2 ** 62
    for row, ids in zip(scores, top.id):
        assert ids.tolist() == np.lexsort((np.arange(3000), -row))[:5].tolist()


def test_warc(spark):
    rows = [(1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (3, "u3", None), (4, "u4", ""),
            (5, None, "é\r\n\r\nWARC/1.1\r\n"), (6, "u6", "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "page_id long, url string, html string, payload_bytes int").repartition(3)
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"])
           for r in round_trip(df).collect()}
    assert got == {1: (8, "response", None), 2: (8, "revisit", 1), 3: (0, "response", None),
                   4: (0, "revisit", 3), 5: (16, "response", None), 6: (100_000, "response", None)}
    assert round_trip(df.where("false")).count() == 0


def test_warc_row_per_page(spark):
    rows = [(1, "u1", "a"), (1, "u2", "a"), (1, "u2", "a"), (2, "u1", "a"), (2, None, "a"), (3, "u3", "a"),
            (4, "u4", "b"), (4, "u4", "b"), (5, "u5", "c"), (5, "u5", "d"),
            (None, "u6", None), (None, "u7", None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = round_trip(df).select("page_id", "target_uri", "payload_bytes", "record_type", "refers_to").collect()
    want = [(i, u, len(t or ""), "revisit" if t == "a" and i > 1 else "response",
             1 if t == "a" and i > 1 else None) for i, u, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_language_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lettered = docs.where(r"text rlike '\\p{L}'").count()
    rows = docs.where("lang is not null and length(text) > 1500").select("lang", "text").collect()
    by_lang = {r["lang"]: r["text"][:1500] for r in sorted(rows)}
    assert len(by_lang) > 2
    even = "\n".join(t[k:k + 300] for k in range(0, 1500, 300) for t in by_lang.values())
    odd = [(-1, even, None), (-2, "12 34", None), (-3, "Hi", None)]
    more = spark.createDataFrame(odd, "doc_id long, text string, lang string").unionByName(
        docs.select("doc_id", "text", "lang"))
    kept = {r["doc_id"] for r in keep_identified(more).select("doc_id").collect()}
    assert len([i for i in kept if i >= 0]) == lettered      # clean documents stay
    assert {i for i in kept if i < 0} == {-3}


def test_language_without_labels(documents):
    rows = [(2, "some words", None), (3, "12 34", None), (4, None, None), (None, "b", None)]
    assert sorted(r["text"] for r in keep_identified(documents(rows)).collect()) == ["b", "some words"]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = out.where("lang is not null and lang_pred <> 'und'").agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 20 and right / n >= 0.9


def test_language_odd_rows(documents):
    got = {r["doc_id"]: (r["lang_pred"], r["score"])
           for r in identify(documents([(2, None, None), (3, "12 34", None), (4, "", None)])).collect()}
    assert got == {k: ("und", 0.0) for k in (2, 3, 4)}
    assert identify(documents([(1, "a")]).where("false")).count() == 0
