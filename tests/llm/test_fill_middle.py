"""Fill-in-the-middle against a plain version, and the exact round trip."""

import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gamestats.llm import fill_middle
from gamestats.llm.fill_middle import fill_in_middle, fill_in_middle_digest, restored

TEXTS = ["", None, "one line", "one line\n", "\n", "\n\n\n", "a\nb\nc", "a\n\nb\n", "é\nü€\n𝄞 end",
         "has <P> in it\nand more\n", "<S>", "x <M", "tail <\nP>\n<\nS>", "\r\na\r\nb", "P>\nS>\nM>"]
ROWS = ([(i, t) for i, t in enumerate(TEXTS * 8)] + [(None, "no id\nat all\n")] * 2
        + [(3, "same id\nother text")] * 2 + [(10 ** 15, "word \n" * 40000), (-4, "minus\nfour\n")])


def plain_version(doc_id, text, seed=7, rate=100, suffix_first=50):
    text = text or ""
    line = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted(x % (len(line) + 1) for x in h[:2])
    p, m, s = "".join(line[:a]), "".join(line[a:b]), "".join(line[b:])
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(line), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(line), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(line), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def _key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("options", [{}, {"seed": 8, "rate": 40, "suffix_first": 20}])
def test_equals_the_plain_version(spark, options):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = fill_in_middle(docs, **options)
    back = got.withColumn("back", restored(F.col("output"), F.col("form")))
    got = sorted(map(_key, back.select("doc_id", "text", "n", "form", "prefix_chars",
                                       "middle_chars", "output", "back").collect()))
    want = sorted(_key((i, t, *plain_version(i, t, **options), t or "")) for i, t in ROWS)
    assert got == want
    assert {"plain", "psm", "spm"} == {r[3] for r in got}


def test_small_slices_give_the_same(spark, monkeypatch):
    parts = list(fill_middle._slices(pa.array(["a" * 10] * 7 + ["b" * 100, "", "c"]), 25))
    assert parts == [(0, 2), (2, 2), (4, 2), (6, 1), (7, 1), (8, 2)]
    assert list(fill_middle._slices(pa.array([], pa.string()))) == []
    assert list(fill_middle._slices(pa.array(["", "", ""]), 4)) == [(0, 3)]


def test_other_columns_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a\nb\n", 5, "old", [1, None], "x"), (2, None, 6, None, None, "y")],
                                 "doc_id long, text string, n int, form string, _row array<int>, `_h0` string")
    got = fill_in_middle(docs)
    assert got.columns == ["doc_id", "text", "_row", "_h0", "n", "form", "prefix_chars",
                           "middle_chars", "output"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["_row"] == [1, None] and rows[2]["_h0"] == "y" and rows[1]["n"] == 2
    assert rows[2]["text"] is None and rows[2]["output"] == "" and rows[2]["form"] == "plain"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(docs).count() == 0 and fill_in_middle_digest(docs).count() == 0


def test_digest_equals_its_sql(spark, duck):
    from oracle_check import compare

    from gamestats.llm.queries import ORACLE_SQL, QUERIES
    name = "op13_fill_in_middle"
    problems, rows = compare(spark, duck, name, QUERIES[name], ORACLE_SQL[name],
                             "/root/testdata/sf0.001")
    assert not problems and rows == 200
