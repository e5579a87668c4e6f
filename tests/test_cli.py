"""The command line: one catalogue query from a games / ratings file to files."""

import os

import pytest

from gamestats.cli import main

from conftest import FIXTURES

GAMES = os.path.join(FIXTURES, "games.csv")
RATINGS = os.path.join(FIXTURES, "ratings.tsv")


def _single_csv(folder):
    parts = [p for p in os.listdir(folder) if p.startswith("part-")]
    assert len(parts) == 1
    return open(os.path.join(folder, parts[0])).read().splitlines()


def test_sorted_query_to_one_file(spark, tmp_path):
    out = str(tmp_path / "by_moves")
    main(["avg_captures_by_moves", GAMES, out, "--single"], spark=spark)
    lines = _single_csv(out)
    assert lines[0] == "moves,avg_captures"
    moves = [int(line.split(",")[0]) for line in lines[1:]]
    assert moves == sorted(moves) == [0, 2, 3, 4, 7]


def test_top_k_keeps_its_rank_order(spark, tmp_path):
    out = str(tmp_path / "draws")
    main(["draw_pct_by_opening_top50", GAMES, out, "--single"], spark=spark)
    rows = _single_csv(out)[1:]
    assert rows[0].startswith('"A00#Polish Opening') and rows[1].startswith("D06#Queen's Gambit")
    assert [float(r.rsplit(",", 1)[1]) for r in rows] == sorted(
        (float(r.rsplit(",", 1)[1]) for r in rows), reverse=True)


def test_rating_query_from_tsv(spark, tmp_path):
    out = str(tmp_path / "best")
    main(["series_best_names", RATINGS, out, "--output-format", "parquet"], spark=spark)
    got = {r["series"]: r["best_names"] for r in spark.read.parquet(out).collect()}
    assert got == {"Show#A#2001": "Finale", "Other#C#2010": "Ep1 | Ep2"}


def test_unknown_query_is_rejected(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["no_such_query", GAMES, str(tmp_path / "x")], spark=spark)


def test_all_game_queries_in_one_run(spark, tmp_path):
    from gamestats.plans.catalog import GAME_QUERIES

    out = tmp_path / "all"
    main(["all-games", GAMES, str(out), "--output-format", "parquet"], spark=spark)
    assert sorted(os.listdir(out)) == sorted(GAME_QUERIES)
    by_event = {r["event"]: r["avg_captures"]
                for r in spark.read.parquet(str(out / "avg_captures_by_event")).collect()}
    assert by_event == pytest.approx({"Blitz": 2 / 3, "Classical": 1.0, "Bullet": 0.0})


def test_all_rating_queries_in_one_run(spark, tmp_path):
    from gamestats.plans.catalog import RATING_QUERIES

    out = tmp_path / "all_ratings"
    main(["all-ratings", RATINGS, str(out), "--single"], spark=spark)
    assert sorted(os.listdir(out)) == sorted(RATING_QUERIES)


def test_explain_prints_the_plan(spark, tmp_path, capsys):
    main(["white_wins_by_opening_event", GAMES, str(tmp_path / "w"), "--explain"], spark=spark)
    out = capsys.readouterr().out
    assert "Physical Plan" in out and "PushedFilters" in out
