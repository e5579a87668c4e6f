"""Compression-distance scores: the counts against a plain version, held-out
accuracy, and the cases that the docstring names."""

import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from gamestats.llm import toxicity as T
from gamestats.llm.toxicity import toxicity

LABELS = "doc_id long, toxic int, quality int"


def _words(rng, n):
    return ["".join(rng.choice(["th", "an", "er", "on", "re", "st", "ou", "ea"]) for _ in range(rng.randint(1, 4)))
            for _ in range(n)]


def _made(rng, toxic, n=120):
    words = _words(rng, n)
    for _ in range(4 if toxic else 0):
        words[rng.randrange(n)] = rng.choice(["zwarfkin", "blughead", "mufkrots"]) + rng.choice(["", "s", "er"])
    return " ".join(words) + ".\nEnd"


def _corpus(n=900, every=4):
    rng = random.Random(11)
    return [(i, _made(rng, i % every == 0)) for i in range(n)], [(i, int(i % every == 0), 1) for i in range(n)]


def test_windows_cover_the_whole_text(monkeypatch):
    rng = random.Random(5)
    text = " ".join(_words(rng, 3000) + ["Ünï-CODE", "x" * 100, "a1b2"]).encode()
    low = re.findall(rb"[a-z\x80-\xff]+", text.lower())
    want = [w[k:k + 32] for w in low for k in range(0, len(w), 32)]
    assert T.all_windows(text) == want
    monkeypatch.setattr(T, "STRETCH", 50)
    assert T.all_windows(text) == want
    assert T.all_windows(b"") == [] and T.all_windows(b"12 34 !?") == []


def test_stretches_and_significant_strings():
    marks = {b" idio", b"idiot", b"diot "}
    assert list(T.stretches(b"idiot", marks, (5,))) == [b" idiot "]
    assert list(T.stretches(b"other", marks, (5,))) == []
    toxic, ordinary = [[b"clown", b"the"]] * 30, [[b"the", b"clock"]] * 90
    found = T.distinctive(toxic, ordinary, (5,))
    assert b"clown" in found and b" the " not in found and b"clock" not in found


def test_counts_equal_a_plain_version():
    rng = random.Random(7)
    toxic = [_made(rng, True).encode() for _ in range(60)]
    ordinary = [_made(rng, False).encode() for _ in range(120)]
    fit = T.trained(toxic, ordinary).open()
    text = b" ".join(toxic[:5] + ordinary[:5])

    def length(content, window):
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False,
            write_dict_id=False, compression_level=3, strategy=zstandard.STRATEGY_LAZY2, min_match=4,
            window_log=12, hash_log=12, chain_log=12, search_log=4, target_length=64)
        return len(zstandard.ZstdCompressor(compression_params=how, dict_data=raw)
                   .compress((b" " + window) * 8 + b" "))

    words = re.findall(rb"[a-z\x80-\xff]+", text.lower())
    d = [length(fit.ordinary, w) - length(fit.toxic, w) for w in words]
    assert fit.counts(text) == (len(words), [sum(x >= t for x in d) for t in T.THRESHOLDS])
    assert fit.difference(b"zwarfkins") >= 3 > fit.difference(b"thaneron")
    assert fit.counts(b"") == (0, [0] * len(T.THRESHOLDS))


def test_dictionary_of_too_few_samples():
    assert T.dictionary([], 100) == b""
    assert T.dictionary([b"blughead ", b"zwarfkin ", b"zwarfkin ", b"x"], 100) == b"blughead zwarfkin "
    assert T.Distance(b"", b"").open().difference(b"word") == 0


def test_learned_rows_and_scores(spark):
    docs, labels = _corpus()
    odd = [(None, docs[0][1]), (5000, None), (5001, ""), (5002, "12 34"), (0, docs[0][1]), (0, docs[0][1]),
           (5003, docs[1][1] * 300), (5004, docs[4][1] + docs[1][1] * 2)]
    # held-out labels, and those without an id or a value, tell nothing
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, 1) for i, t, _ in labels]
    turned += [(None, 1, 1), (3, None, 1), (4, 0, 1)]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string").repartition(3) \
        .withColumns({"windows": F.lit(1), "toxic": F.lit("x"), "score": F.lit(2), "k": F.lit(3)})
    got = toxicity(table, spark.createDataFrame(turned, LABELS)).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: t for i, t, _ in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert not by_id[None]["held_out"] and by_id[None]["score"] == by_id[0]["score"]
    assert by_id[5000]["windows"] == by_id[5001]["windows"] == by_id[5002]["windows"] == 0
    assert by_id[5000]["score"] == by_id[5001]["score"] == by_id[5002]["score"] < 0.5
    assert by_id[5003]["windows"] > 30000 and by_id[5004]["predicted"] == 1
    assert len([r for r in got if r["doc_id"] == 0]) == 3


@pytest.mark.parametrize("labels, want", [([], 0.0), ([(1, 0, 1), (2, 0, 1)], 0.0), ([(1, 1, 1), (2, 1, 1)], 1.0)])
def test_labels_of_one_kind(spark, labels, want):
    docs = spark.createDataFrame([(i, f"text of {i}") for i in range(4)], "doc_id long, text string")
    got = toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert [r["score"] for r in got] == [want] * 4 and {r["predicted"] for r in got} == {int(want)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity(none, spark.createDataFrame([(1, 1, 1), (2, 0, 1)], LABELS)).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    from gamestats.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op12_toxicity"](spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    rows = {(r["toxic"], r["predicted"]): r["n"] for r in
            got.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    # a tenth of the labels there is noise
    assert rows[1, 1] >= 0.65 * (rows[1, 1] + rows.get((1, 0), 0))
    assert rows.get((0, 1), 0) <= 0.02 * rows[0, 0]
