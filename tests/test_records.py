"""Quoted records and the ledger against plain parsers, over blocks far smaller
than the files."""

import csv
import math
import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from gamestats.sources.ledger import (games_with_ledger, ledger_counts, ratings_table,
                                      ratings_with_ledger, rejects_of, rows_of)
from gamestats.sources.records import numbered_lines, parsed, quoted_records, text_lines

CELLS = StructType([StructField(c, StringType()) for c in "abcd"])


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "120", "spark.sql.files.openCostInBytes": "1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def _cell(rng, signs):
    return "".join(rng.choice(signs) for _ in range(rng.randrange(7)))


def _write(path, rows, **options):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, **({"lineterminator": "\n"} | options)).writerows(rows)


def test_quoted_line_breaks_equal_a_plain_parser(spark, tmp_path, small_blocks):
    rng = random.Random(1)
    want = []
    for f, signs in enumerate([["a", "b", ",", "é"], ["a", ",", '"', "\n", "é", " "], ["x", "\r\n", "\n\n", '""', ","]]):
        rows = [[f"{f}-{i}", _cell(rng, signs), _cell(rng, signs), "z"] for i in range(80)]
        _write(tmp_path / f"f{f}.csv", rows, lineterminator="\r\n" if f == 2 else "\n")
        want += rows
    long = [["3-0", 'long "quoted"\n' * 60, ",", "z"], ["3-1", "", "", "z"]]
    _write(tmp_path / "f3.csv", long)
    assert text_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 25
    got = parsed(quoted_records(spark, str(tmp_path)), CELLS)
    assert got.where("_corrupt IS NOT NULL").count() == 0
    have = sorted([r["a"], r["b"] or "", r["c"] or "", r["d"]] for r in got.collect())
    assert have == sorted(want + long)


@pytest.mark.parametrize("blocks", [True, False])
def test_records_over_the_edges_of_batches(spark, tmp_path, request, blocks):
    if blocks:
        request.getfixturevalue("small_blocks")
    rng = random.Random(2)
    want = []
    for f in range(4):
        rows = [[f"{f}-{i}", _cell(rng, ["a", "\n", '"', "\n\n", "é"]), _cell(rng, ["b", '"', ","]), "z"] for i in range(60)]
        _write(tmp_path / f"f{f}.csv", rows)
        want += rows
    for rows_of_batch in ("1", "3"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_of_batch)
        try:
            got = parsed(quoted_records(spark, str(tmp_path)), CELLS).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted([r["a"], r["b"] or "", r["c"] or "", r["d"]] for r in got) == sorted(want)


def test_the_lines_of_records_are_neither_shuffled_nor_written(spark, tmp_path, monkeypatch):
    """Only blocks, and the pieces at the edges of batches, are."""
    from gamestats.sources import records

    _write(tmp_path / "f.csv", [[str(i), "two\nlines" if i % 3 == 0 else "", "b", "c"] for i in range(30_000)])
    kept = []
    monkeypatch.setattr(records, "written", lambda df, name, w=records.written: kept.append((df, w(df, name))) or kept[-1][1])
    out = quoted_records(spark, str(tmp_path))
    assert out.count() == 30_000
    batches = 40_000 // int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) + spark.sparkContext.defaultParallelism
    assert sum(table.count() for _, table in kept) <= 3 * batches
    for df, _ in kept:
        if "line" in df.columns or "record" in df.columns:
            assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_records_carry_the_line_they_begin_in(spark, tmp_path, small_blocks):
    rows = [[str(i), "x\n" * (i % 4), "b", "c"] for i in range(90)]
    _write(tmp_path / "f.csv", rows)
    at, want = 1, {}
    for i, r in enumerate(rows):
        want[str(i)] = at
        at += 1 + r[1].count("\n")
    got = parsed(quoted_records(spark, str(tmp_path / "f.csv")), CELLS)
    assert {r["a"]: r["number"] for r in got.collect()} == want
    lines = numbered_lines(spark, str(tmp_path / "f.csv")).collect()
    assert sorted(r["number"] for r in lines) == list(range(1, at))


def test_an_unclosed_quote_takes_the_rest_of_its_file(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('1,2,3,4\n5,"6,7,8\n9,10,11,12\n')
    (tmp_path / "b.csv").write_text("1,2,3,4\n")
    got = sorted((r["number"], r["record"]) for r in quoted_records(spark, str(tmp_path)).collect())
    assert got == [(1, "1,2,3,4"), (1, "1,2,3,4"), (2, '5,"6,7,8\n9,10,11,12')]


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert quoted_records(spark, str(tmp_path)).count() == 0
    assert numbered_lines(spark, str(tmp_path)).count() == 0
    assert ratings_with_ledger(spark, str(tmp_path)).count() == 0


LINES = ["tt\t1\taverage\tShow\tA\t2001\ttitleType\tname", "tt\t1\t7.5\tShow\tA\t2001\tTV_SERIES\tone",
         "tt\t1\t8.5\tShow\tA\t2001\tTV_SERIES\t\r", "tt\t1\tNaN\tShow\tA\t2001\tTV_SERIES\tnan",
         "tt\t1\t-Infinity\tShow\tA\t2001\tTV_SERIES\tinf", "tt\t1\t9\tShow\tA", "", "tt\t1\t1e1\tS\tB\t\tMOVIE\tx\textra"]


def test_ratings_ledger(spark, tmp_path, small_blocks):
    for name in ("one.tsv", "two.tsv"):
        (tmp_path / name).write_bytes("\n".join(LINES * 3).encode())
    ledger = ratings_with_ledger(spark, str(tmp_path))
    counts = {r["file"][-7:]: r for r in ledger_counts(ledger).collect()}
    assert set(counts) == {"one.tsv", "two.tsv"}
    for r in counts.values():
        assert (r["records"], r["rows"], r["rejects"]) == (24, 9, 15)
        assert (r["rejected_fields"], r["rejected_rating"], r["rejected_not_finite"]) == (6, 3, 6)
    rejects = [r for r in rejects_of(ledger).collect() if r["file"].endswith("one.tsv")]
    for r in rejects:
        assert r["text"] == LINES[(r["number"] - 1) % 8].rstrip("\r")
    rows = rows_of(ledger).collect()
    assert {(r["series"], r["episode"], r["rating"], r["type"]) for r in rows} == {
        ("Show#A#2001", "one", 7.5, "TV_SERIES"), ("Show#A#2001", "", 8.5, "TV_SERIES"), ("S#B#", "x", 10.0, "MOVIE")}
    assert all(math.isfinite(r["rating"]) for r in rows)
    table = ratings_table(spark, str(tmp_path))
    assert table.count() == 48 and table.where("reason IS NULL").count() == 18
    assert set(table.inputFiles()) == set(ratings_table(spark, str(tmp_path)).inputFiles())    # written once


def test_games_ledger(spark, tmp_path):
    header = "id,event,white,black,result,white_elo,black_elo,eco,opening,time_control,termination,an"
    good = '1, Blitz ,w,b,1-0,1500,1400,B90,"Sicilian, ""Najdorf""",180,"lost\non time",1. e4 e5'
    bad = ["2,too,few", "x,Blitz,w,b,1-0,1,2,B90,o,180,Normal,1. e4", good + ",one,more"]
    (tmp_path / "g.csv").write_text("\n".join([header, good, *bad, good.replace("1,", "7,", 1)]) + "\n")
    ledger = games_with_ledger(spark, str(tmp_path))
    rows = {r["id"]: r for r in rows_of(ledger).collect()}
    assert set(rows) == {1, 7} and rows[1]["opening"] == 'Sicilian, "Najdorf"'
    assert rows[1]["termination"] == "lost\non time" and rows[1]["event"] == " Blitz "
    assert sorted((r["number"], r["text"]) for r in rejects_of(ledger).collect()) == [
        (4, bad[0]), (5, bad[1]), (6, bad[2])]
    counted = ledger_counts(ledger).first()
    assert (counted["records"], counted["rows"], counted["rejects"], counted["rejected_record"]) == (5, 2, 3, 3)
