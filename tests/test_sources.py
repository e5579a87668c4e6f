"""Readers (S1-S4) and the star-schema views."""

import os

from gamestats.sources.files import (GAMES_COLUMNS, read_games_csv, read_games_lines,
                                     read_ratings_tsv)
from gamestats.sources.star import games_from_star, ratings_from_events

from conftest import FIXTURES, SF_SMALL

GAMES = os.path.join(FIXTURES, "games.csv")
RATINGS = os.path.join(FIXTURES, "ratings.tsv")


def test_csv_reader_keeps_quoted_commas(spark):
    df = read_games_csv(spark, GAMES)
    assert df.columns == list(GAMES_COLUMNS)
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 7                                   # header is not data (D4)
    assert rows[1]["opening"] == "Sicilian Defense: Najdorf, English Attack"
    assert rows[3]["opening"] == "Polish Opening, Outflank Variation, Queenside"
    assert rows[1]["event"] == " Blitz "                    # stripped later, not here
    assert rows[1]["an"].endswith("Nxd4+ Nf6")
    assert rows[5]["an"] is None


def test_naive_split_reader_shows_the_reference_defects(spark):
    """D4 + D5: the header is a data row and a quoted comma shifts the fields."""
    df = read_games_lines(spark, GAMES)
    rows = df.collect()
    assert len(rows) == 8
    assert rows[0]["event"] == "event" and rows[0]["id"] is None
    shifted = [r for r in rows if r["id"] == 1][0]
    assert shifted["opening"] == '"Sicilian Defense: Najdorf'
    assert shifted["an"] == "Normal"


def test_tsv_reader(spark):
    df = read_ratings_tsv(spark, RATINGS)
    assert df.columns == ["series", "episode", "rating", "type"]
    rows = df.collect()
    assert len(rows) == 8
    header = [r for r in rows if r["type"] == "titleType"][0]
    assert header["rating"] is None
    assert {r["series"] for r in rows if r["type"] == "TV_SERIES"} == {"Show#A#2001",
                                                                       "Other#C#2010"}


def test_star_view_shape(spark, star_small):
    n_orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert star_small.count() == n_orders                    # left join keeps all orders
    row = star_small.where("moves = 0").first()              # an order without line items
    if row is not None:
        assert row["captures"] == 0 and row["black"] is None
    assert set(r["event"] for r in star_small.select("event").distinct().collect()) == {
        "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"}


def test_star_text_round_trip_through_csv(spark, tmp_path):
    """Export the view with its move text, read it back with the CSV reader and
    measure the text: the per-line-item sums must equal the text measures."""
    from gamestats.operators.measured import measure_games
    from gamestats.sinks import write_parts

    with_text = games_from_star(spark, SF_SMALL, with_text=True)
    raw = with_text.select(*GAMES_COLUMNS)
    out = str(tmp_path / "games_csv")
    write_parts(raw, out, fmt="csv")
    back = measure_games(read_games_csv(spark, out))
    cols = ["id", "moves", "captures", "checks", "castled", "castled_dash", "draw",
            "white_win", "black_win", "elo_band", "elo_band_text", "elo_band_mean",
            "elo_band_black", "event", "opening"]
    a = with_text.select(*cols)
    b = back.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ratings_view(spark):
    r = ratings_from_events(spark, SF_SMALL)
    assert r.columns == ["series", "episode", "rating", "type"]
    assert dict(r.dtypes)["rating"] == "double"


def test_numbered_moves_from_fragments_equal_text_count(spark):
    from gamestats.functions.measures import moves

    view = games_from_star(spark, SF_SMALL, moves_mode="numbered", with_text=True)
    bad = view.where(moves("an", "numbered") != view["moves"]).count()
    assert bad == 0


def test_star_text_is_listed_after_one_shuffle_of_the_lines(spark, tmp_path):
    """Own rows: repeated and null line numbers, null keys, an order without
    lines.  The lines are read and shuffled once, and no list is begun before."""
    lines = [(1, 7, 2, 2, 10.0, 5.0, "R", "F"), (1, 7, 9, 1, 50.0, 5.0, "A", "F"), (1, 7, 1, 2, 10.0, 5.0, "N", "O"),
             (1, 7, 1, 2, 10.0, 5.0, "N", "O"), (1, None, 4, None, 1.0, 5.0, "A", "F"), (None, 1, 1, 1, 1.0, 1.0, "R", "F"),
             (3, 5, None, 1, None, None, "A", None), (3, 5, None, 1, 45.0, None, None, None)]
    lines += [(4, 1, 20 - i, i, 1.0, 1.0, "R", "F") for i in range(1, 13)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                 "l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, 5, "F", "1-URGENT") for k in (1, 2, 3, 4, None)], "o_orderkey long, o_custkey long, "
                          "o_orderstatus string, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    games = games_from_star(spark, str(tmp_path), with_text=True).select(*GAMES_COLUMNS)
    plan = games._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    below = plan[plan.index("Exchange hashpartitioning(l_orderkey"):]
    assert "Aggregate" not in below
    assert {r["id"]: (r["black"], r["an"]) for r in games.collect()} == {
        1: ("s1", "1. Rxe8++ 2. O-O 2. O-O 2. Nxe5"), 2: (None, ""), 3: (None, "1. Qh5+ 1. e4"),
        4: ("s8", " ".join(f"{i}. Nxe5" for i in range(1, 13))), None: (None, "")}


def test_parquet_games_path(spark, tmp_path, games_csv):
    """Games kept as Parquet read, measure and stream like the CSV."""
    import pytest

    from gamestats.plans import catalog as C
    from gamestats.sources.files import measured_games_table
    from gamestats.streaming import read_games_stream, start_keyed_stream

    folder = str(tmp_path / "games_parquet")
    read_games_csv(spark, GAMES).write.parquet(folder)
    t = measured_games_table(spark, folder, fmt="parquet")
    assert t.exceptAll(games_csv).count() == 0 and games_csv.exceptAll(t).count() == 0

    stream = read_games_stream(spark, folder, fmt="parquet")
    start_keyed_stream(stream, C.avg_moves_by_event, "moves_parquet_stream",
                       checkpoint=str(tmp_path / "ckpt"), available_now=True).awaitTermination(120)
    got = {r["event"]: r["avg_moves"] for r in spark.table("moves_parquet_stream").collect()}
    want = {r["event"]: r["avg_moves"] for r in C.avg_moves_by_event(games_csv).collect()}
    assert got == pytest.approx(want)


def test_empty_key_parts_and_names_are_kept(spark, tmp_path):
    from gamestats.operators import measure_games
    from gamestats.operators.best import all_names, rated_items
    from gamestats.plans import catalog as C
    from gamestats.sources import read_games_csv, read_ratings_tsv

    lines = ["t\tu\t5.0\tx\t\ty\tTV_SERIES\tE1", "t\tu\t6.0\tx\ty\t\tTV_SERIES\tE2",
             "t\tu\t7.0\tz\tz\tz\tTV_SERIES\t", "t\tu\t8.0\tw\tw\tw\tTV_SERIES\tnull"]
    (tmp_path / "r.tsv").write_text("\n".join(lines) + "\n")
    items = rated_items(read_ratings_tsv(spark, str(tmp_path / "r.tsv")))
    got = {r["series"]: r["names"] for r in all_names(items, "series", "rating", "episode").collect()}
    assert got == {"x##y": "E1", "x#y#": "E2", "z#z#z": ""}

    head = "id,event,white,black,result,white_elo,black_elo,eco,opening,time_control,termination,an"
    rows = ["1,E,a,b,1/2-1/2,1500,1500,,B20,60,Normal,1. e4", "2,E,a,b,1-0,1500,1500,B20,,60,Normal,1. e4"]
    (tmp_path / "g.csv").write_text("\n".join([head, *rows]) + "\n")
    games = measure_games(read_games_csv(spark, str(tmp_path / "g.csv")))
    for query in (C.draw_pct_by_opening_top50, C.draw_pct_by_opening, C.draw_pct_by_opening_joined):
        assert {r["eco_opening"]: r["draw_pct"] for r in query(games).collect()} == {
            "#B20": 100.0, "B20#": 0.0}
