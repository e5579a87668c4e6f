"""Catalogue queries on the CSV fixture (hand-computed), properties on the
star view, and the SQL oracle on the driver's tables."""

import os

import pytest
from pyspark.sql import functions as F

from gamestats.operators.keyed import keyed_pct, keyed_ratio
from gamestats.plans import catalog as C
from gamestats.plans.oracle import oracle_sql
from gamestats.sources.files import read_ratings_tsv

from conftest import FIXTURES, SF_ORACLE, SF_SMALL
from oracle_check import compare, duck_connection


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_means_by_event(games_csv):
    got = as_dict(C.avg_captures_by_event(games_csv), "event", "avg_captures")
    assert got == pytest.approx({"Blitz": 2 / 3, "Classical": 1.0, "Bullet": 0.0})
    got = as_dict(C.avg_checks_by_event(games_csv), "event", "avg_checks")
    assert got == pytest.approx({"Blitz": 1 / 3, "Classical": 2.5, "Bullet": 0.0})
    got = as_dict(C.avg_moves_by_event(games_csv), "event", "avg_moves")
    assert got == pytest.approx({"Blitz": 13 / 3, "Classical": 3.5, "Bullet": 0.0})


def test_means_by_band_are_sorted(games_csv):
    rows = C.avg_captures_by_elo(games_csv).collect()
    bands = [r["elo_band"] for r in rows]
    assert bands == sorted(bands)
    assert dict((r["elo_band"], r["avg_captures"]) for r in rows) == pytest.approx(
        {"CM": 0.5, "IM-GM": 1.0, "SGM": 0.0, "class B": 0.0, "class C": 2.0, "class D": 0.0})
    text = as_dict(C.avg_captures_by_elo(games_csv, "elo_band_text"), "elo_band", "avg_captures")
    assert text == pytest.approx({"SGM": 1.0, "class D": 0.0, "CM": 0.0, "class B": 0.0,
                                  "IM-GM": 1.0})


def test_checks_by_band_falls_back_to_black(games_csv):
    got = as_dict(C.avg_checks_by_elo(games_csv), "elo_band", "avg_checks")
    assert got == pytest.approx({"class D": 1.0, "CM": 1.0, "novice": 0.0, "GM": 0.0,
                                 "class A": 0.0, "class C": 0.0, "FM-IM": 4.0})


def test_top_k_breaks_ties_on_key(games_csv):
    rows = C.draw_pct_by_opening_top50(games_csv).collect()
    assert [(r["eco_opening"], r["draw_pct"]) for r in rows[:2]] == [
        ("A00#Polish Opening, Outflank Variation, Queenside", 100.0),
        ("D06#Queen's Gambit", 100.0)]
    assert len(rows) == 6


def test_castling_modes_differ(games_csv):
    notation = as_dict(C.castling_pct_by_event_top50(games_csv), "event", "castling_pct")
    dash = as_dict(C.castling_pct_by_event_top50(games_csv, "castled_dash"), "event",
                   "castling_pct")
    assert notation == pytest.approx({"Blitz": 100 / 3, "Classical": 50.0, "Bullet": 0.0})
    assert dash == pytest.approx({"Blitz": 200 / 3, "Classical": 50.0, "Bullet": 0.0})


def test_rating_queries_on_tsv(spark):
    r = read_ratings_tsv(spark, os.path.join(FIXTURES, "ratings.tsv"))
    tv = "TV_SERIES"
    avg_max = {x["series"]: (x["avg_rating"], x["max_rating"])
               for x in C.series_avg_max(r, tv).collect()}
    assert avg_max == {"Show#A#2001": pytest.approx((8.8, 9.1)),
                       "Other#C#2010": pytest.approx((7.5, 8.0))}
    names = as_dict(C.series_all_names(r, tv), "series", "names")
    assert names == {"Show#A#2001": "Finale | Pilot", "Other#C#2010": "Ep1 | Ep2 | Ep3"}
    best = as_dict(C.series_best_names(r, tv), "series", "best_names")
    assert best == {"Show#A#2001": "Finale", "Other#C#2010": "Ep1 | Ep2"}


# --- properties on the star view --------------------------------------------

def test_weighted_mean_over_keys_is_global_mean(star_small):
    per_event = star_small.groupBy("event").agg(F.count("*").alias("n"),
                                                F.avg("captures").alias("m"))
    total = per_event.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).first()[0]
    assert total == pytest.approx(star_small.agg(F.avg("captures")).first()[0])


def test_percentages_in_range(star_small):
    for q in (C.draw_pct_by_opening, C.black_win_pct_by_opening, C.castling_pct_by_moves):
        df = q(star_small)
        value = [c for c in df.columns if c.endswith("pct")][0]
        lo, hi = df.agg(F.min(value), F.max(value)).first()
        assert 0.0 <= lo <= hi <= 100.0


def test_top50_is_prefix_of_sorted_full(star_small):
    top = [tuple(r) for r in C.draw_pct_by_opening_top50(star_small).collect()]
    full = C.draw_pct_by_opening(star_small).orderBy(F.desc("draw_pct"), "eco_opening")
    assert top == [tuple(r) for r in full.limit(50).collect()]


def test_join_form_equals_single_pass(star_small):
    g = star_small.withColumn("eco_opening", F.concat_ws("#", "eco", "opening"))
    a = keyed_ratio(g, "eco_opening", "draw", "p")
    b = keyed_pct(g, "eco_opening", "draw", "p")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_grouping_sets_slices_equal_single_key_queries(star_small):
    gs = C.game_stats_grouping_sets(star_small).cache()
    ev = gs.where("grouping_set = 'event'").select("event", F.col("avg_captures"))
    assert ev.exceptAll(C.avg_captures_by_event(star_small)).count() == 0
    ev = gs.where("grouping_set = 'event'").select("event", F.col("avg_checks"))
    assert ev.exceptAll(C.avg_checks_by_event(star_small)).count() == 0
    mv = gs.where("grouping_set = 'moves'").select(F.col("moves").cast("long"), "avg_checks")
    assert mv.exceptAll(C.avg_checks_by_moves(star_small)).count() == 0
    oe = gs.where("grouping_set = 'opening_event'").select(
        F.concat_ws("#", "opening", "event").alias("opening_event"), "draw_share")
    assert oe.exceptAll(C.draw_share_by_opening_event(star_small)).count() == 0
    band = gs.where("grouping_set = 'elo_band'").select("elo_band", "avg_captures")
    assert band.exceptAll(C.avg_captures_by_elo(star_small, "elo_band_mean")).count() == 0
    sizes = gs.groupBy("grouping_set").agg(F.sum("games").alias("n")).collect()
    assert len({r["n"] for r in sizes}) == 1                 # every set covers all games
    gs.unpersist()


def test_sample_is_repeatable_subset(star_small):
    full = {tuple(r) for r in C.draw_share_by_opening_event(star_small).collect()}
    s1 = [tuple(r) for r in C.draw_share_sample10(star_small).collect()]
    s2 = [tuple(r) for r in C.draw_share_sample10(star_small).collect()]
    assert s1 == s2 and len(s1) == 10 and set(s1) <= full


# --- SQL oracle on the driver's tables ---------------------------------------

ALL = sorted(C.star_queries())


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(ALL)


@pytest.fixture(scope="module")
def duck_small():
    return duck_connection(SF_SMALL)


@pytest.fixture(scope="module")
def duck_oracle():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", ALL)
def test_oracle_sf0001(spark, duck_small, name):
    problems, _ = compare(spark, duck_small, name, C.star_queries()[name],
                          oracle_sql()[name], SF_SMALL)
    assert not problems, problems


@pytest.mark.parametrize("name", ALL)
def test_oracle_sf001(spark, duck_oracle, name):
    problems, _ = compare(spark, duck_oracle, name, C.star_queries()[name],
                          oracle_sql()[name], SF_ORACLE)
    assert not problems, problems


def test_result_filter_counts_match_share(star_small):
    """white wins per opening#event over all games per opening#event is
    the white-win share."""
    from gamestats.operators.filters import with_result

    wins = with_result(star_small, "1-0").groupBy("opening", "event").count()
    total = star_small.groupBy("opening", "event").agg(F.count("*").alias("n"))
    ratio = (total.join(wins, ["opening", "event"], "left")
             .select(F.concat_ws("#", "opening", "event").alias("opening_event"),
                     (F.coalesce(F.col("count"), F.lit(0)) / F.col("n")).alias("r")))
    share = C.white_win_share_by_opening_event(star_small)
    got = {r["opening_event"]: r["r"] for r in ratio.collect()}
    want = {r["opening_event"]: r["white_win_share"] for r in share.collect()}
    assert got == pytest.approx(want)


def test_sort_by_key_descending(star_small):
    from gamestats.operators.ranking import sort_by_key

    rows = sort_by_key(C.draw_share_by_opening_event(star_small), "opening_event",
                       descending=True).collect()
    keys = [r["opening_event"] for r in rows]
    assert keys == sorted(keys, reverse=True)


def test_as_written_reader_reproduces_the_saved_quirks(spark):
    """Read the way the reference reads (naive comma split, header as data):
    the header becomes an extra key with mean 0.0, and a quoted comma shifts
    the move text so the game counts as length 0."""
    from gamestats.operators.measured import measure_games
    from gamestats.sources.files import read_games_lines

    games = measure_games(read_games_lines(spark, os.path.join(FIXTURES, "games.csv")))
    by_event = as_dict(C.avg_captures_by_event(games), "event", "avg_captures")
    assert by_event["event"] == 0.0
    shifted = games.where("id = 1").first()
    assert shifted["moves"] == 0 and shifted["captures"] == 0
