import random

import pytest
from llm.brute import edit_distance, removed_lines
from pyspark.sql import functions as F

from gamestats.llm.line_dedup import line_dedup, within


def _check(documents, rows):
    gone, near = removed_lines(rows)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_near) for r in line_dedup(documents(rows)).collect()}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for k, x in enumerate(lines) if (i, k) not in gone]
        n = sum(1 for k in range(len(lines)) if (i, k) in gone)
        n_near = sum(1 for k, x in enumerate(lines) if (i, k) in gone and x in near)
        text = None if t is None else "\n".join(kept)
        assert got[i] == (text, 0 if t is None else len(lines), n, n_near), i


def _edited(rng, line, n):
    for _ in range(n):
        k = rng.randrange(len(line))
        line = rng.choice([line[:k] + line[k + 1:], line[:k] + "z" + line[k:], line[:k] + "y" + line[k + 1:]])
    return line


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_lines(documents, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abc éd") for _ in range(rng.randrange(30, 90))) for _ in range(25)]
    rows = [(i, "\n".join(_edited(rng, rng.choice(base), rng.randrange(5)) for _ in range(5)))
            for i in range(60)]
    _check(documents, rows)


def test_cases(documents):
    long = "L" * 60
    _check(documents, [(1, None), (2, ""), (3, "\n\n \n"), (4, "a\na\n b\nB"), (5, "a"),
                       (6, long + "\n" + "L" * 61), (7, long + "x" * 3), (8, "L" * 40),
                       (9, "short line one\nshort line two"), (10, "z" * 1500), (11, "z" * 1498 + "ab"),
                       (12, "q" * 300_000)])


def test_repeated_and_unnamed_rows(documents):
    got = sorted((str(r.doc_id), r.text) for r in line_dedup(documents(
        [(1, "a b\nc"), (1, "a b\nc"), (None, "c\nd"), (2, "c\ne")])).collect())
    assert got == [("1", "a b\nc"), ("1", "a b\nc"), ("2", "e"), ("None", "d")]


def test_rows_without_id_are_several_documents(documents):
    got = sorted((str(r.doc_id), r.text, r.n_removed) for r in line_dedup(documents(
        [(None, "x1\ny1"), (None, "z1\ny2"), (1, "x1"), (None, "w1\ny3")])).collect())
    assert got == [("1", "x1", 0), ("None", "w1\ny3", 0), ("None", "y1", 1), ("None", "z1\ny2", 0)]
    got = [r.text for r in line_dedup(documents([(None, "same\none"), (None, "same\ntwo")])).collect()]
    assert sorted("\n".join(got).split("\n")) == ["one", "same", "two"]


def test_equal_rows_without_id(documents):
    got = sorted((r.text, r.n_lines, r.n_removed) for r in line_dedup(documents(
        [(None, "a\n\nb"), (None, "a\n\nb"), (None, "a\n\nb"), (None, None), (None, None), (4, "b")]))
        .where("text is not null").collect())
    assert got == [("", 3, 2), ("", 3, 2), ("a\n", 3, 1), ("b", 1, 0)]


def test_repeated_id_with_different_texts(documents):
    got = sorted(r.text for r in line_dedup(documents(
        [(0, "x"), (1, "x\nk\np"), (1, "q\nr"), (1, "s\nm\np")])).collect())
    assert sorted("\n".join(got).split("\n")) == ["k", "m", "p", "q", "r", "s", "x"]
    assert "q\nr" in got


def test_near_line_at_the_same_place(documents):
    near, other = "n" * 50 + "abc", "an unrelated line of more than forty bytes, all told"
    got = sorted(r.text for r in line_dedup(documents(
        [(1, "n" * 50 + "abd"), (None, near), (None, other)])).collect())
    assert got == sorted(["n" * 50 + "abd", "", other])


def test_keeps_other_columns(documents):
    df = documents([(1, "a"), (2, "a")])
    out = line_dedup(df)
    assert out.columns[:len(df.columns)] == df.columns
    assert line_dedup(df.where("false")).count() == 0


def test_distance(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(3, 25)))
        pairs.append((a, _edited(rng, a, rng.randrange(6))))
    df = spark.createDataFrame(pairs, "a string, b string").where("length(b) > 2")
    rows = df.withColumn("w", within(F.col("a").cast("binary"), F.col("b").cast("binary"), 2)).collect()
    assert [r.w for r in rows] == [edit_distance(r.a, r.b) <= 2 for r in rows]


def test_counts_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "same line here\nx", 5, "a"), (2, "same line here\ny", 6, "b")],
                                 "doc_id long, text string, n_removed int, n_near string")
    got = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 1 and got[2]["text"] == "y"
    assert got[2]["n_near"] == 0


def test_a_large_group_of_lines_that_share_most_of_a_text(spark, monkeypatch):
    """Each line differs from the others by a word: few pairs are compared, and
    the near ones among them are found."""
    from gamestats.llm import line_dedup as module
    from llm.brute import removed_lines as plain

    rng = random.Random(6)
    words = "the quick brown fox jumps over the lazy dog while seven wizards boil daft pots".split()
    rows = []
    for i in range(110):
        line = list(words)
        line[rng.randrange(len(line))] = "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
        rows.append((i, " ".join(line) + ("" if i % 10 else "s")))
    rows += [(1000 + i, rows[i * 7][1][:-1]) for i in range(12)]
    seen = []
    written = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: (
        lambda out: seen.append(out.count()) or out if name == "line-pairs" else out)(written(df, name)))
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0")
    gone, _ = plain(rows)
    assert {r["doc_id"] for r in got.collect()} == {i for i, _ in gone}
    assert seen[0] < 0.1 * len(rows) ** 2 / 2
