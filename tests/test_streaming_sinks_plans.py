"""Streaming over game files, sinks, and physical-plan checks."""

import os

import pytest

from gamestats.plans import catalog as C
from gamestats.sinks import write_parts, write_single
from gamestats.sources.star import games_from_star, ratings_from_events
from gamestats.streaming import read_games_stream, start_keyed_stream

from conftest import FIXTURES, SF_SMALL


def test_stream_equals_batch(spark, tmp_path, games_csv):
    src = tmp_path / "incoming"
    src.mkdir()
    lines = open(os.path.join(FIXTURES, "games.csv")).read().splitlines()
    header, rows = lines[0], lines[1:]
    (src / "part1.csv").write_text("\n".join([header] + rows[:3]) + "\n")
    stream = read_games_stream(spark, str(src))
    q = start_keyed_stream(stream, C.avg_captures_by_event, "captures_by_event_stream",
                           checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    first = {r["event"]: r["avg_captures"] for r in spark.table("captures_by_event_stream").collect()}
    assert first == pytest.approx({"Blitz": 1.0, "Classical": 1.0})

    (src / "part2.csv").write_text("\n".join([header] + rows[3:]) + "\n")
    q = start_keyed_stream(stream, C.avg_captures_by_event, "captures_by_event_stream",
                           checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = {r["event"]: r["avg_captures"] for r in spark.table("captures_by_event_stream").collect()}
    want = {r["event"]: r["avg_captures"] for r in C.avg_captures_by_event(games_csv).collect()}
    assert got == pytest.approx(want)


def test_sinks_round_trip(spark, tmp_path, star_small):
    res = C.avg_captures_by_moves(star_small)
    write_parts(res, str(tmp_path / "parts"), fmt="parquet")
    back = spark.read.parquet(str(tmp_path / "parts"))
    assert back.exceptAll(res).count() == 0 and res.exceptAll(back).count() == 0
    write_single(res, str(tmp_path / "single"), fmt="csv", sort_by="moves")
    parts = [p for p in os.listdir(tmp_path / "single") if p.startswith("part-")]
    assert len(parts) == 1
    text = open(tmp_path / "single" / parts[0]).read().splitlines()
    keys = [int(line.split(",")[0]) for line in text[1:]]
    assert keys == sorted(keys) and len(keys) == res.count()


def _plan(df):
    """The final adaptive plan (without the initial plan AQE also prints)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(C.star_queries()))
def test_no_python_in_any_plan(spark, name):
    plan = _plan(C.star_queries()[name](spark, SF_SMALL))
    for op in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
               "MapInPandas"):
        assert op not in plan


def test_top_k_is_take_ordered(spark):
    plan = C.draw_pct_by_opening_top50(games_from_star(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan._jdf.queryExecution().executedPlan().toString()


def test_keyed_mean_on_file_games_is_one_exchange(spark, games_csv):
    plan = _plan(C.avg_captures_by_event(games_csv))
    assert plan.count("Exchange hashpartitioning") == 1


def test_grouping_sets_single_aggregation(spark, star_small):
    plan = _plan(C.game_stats_grouping_sets(star_small))
    assert plan.count("Expand") == 1
    assert plan.count("Exchange hashpartitioning(event") == 1


def test_scans_are_pruned(spark):
    df = C.avg_captures_by_event(games_from_star(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "l_shipdate" not in plan and "l_tax" not in plan


def test_rating_filter_pushed_to_scan(spark):
    df = C.series_avg_max(ratings_from_events(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(event_id), EqualTo(event_type,purchase)" in plan


def test_top_k_written_and_shown(spark, tmp_path, star_small, capsys):
    """K4 / K5 / K6: show the top-K on the console, then save it."""
    from gamestats.sinks import show_rows

    top = C.castling_pct_by_elo_top10(star_small)
    show_rows(top, 10)
    show_rows(top, 10, truncate=False)
    out = capsys.readouterr().out
    assert "castling_pct" in out and "elo_band" in out
    write_parts(top, str(tmp_path / "top10"), fmt="csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "top10"))
    assert back.count() == top.count() == 10


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == E.entry(spark).columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_result_filter_pushed_to_games_table_scan(spark):
    df = C.star_queries()["white_wins_by_opening_event"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(result), EqualTo(result,1-0)]" in plan


def test_ranked_query_as_a_stream(spark, tmp_path, games_csv):
    """A top-K query runs on the stream too (complete mode sorts and limits)."""
    src = tmp_path / "incoming_topk"
    src.mkdir()
    (src / "all.csv").write_text(open(os.path.join(FIXTURES, "games.csv")).read())
    stream = read_games_stream(spark, str(src))
    q = start_keyed_stream(stream, C.draw_pct_by_opening_top50, "draw_top_stream",
                           checkpoint=str(tmp_path / "ckpt_topk"), available_now=True)
    q.awaitTermination(120)
    got = [tuple(r) for r in spark.table("draw_top_stream").collect()]
    want = [tuple(r) for r in C.draw_pct_by_opening_top50(games_csv).collect()]
    assert sorted(got) == sorted(want)


def test_stream_to_parquet_keeps_the_complete_result(spark, tmp_path, games_csv):
    src = tmp_path / "incoming_files"
    src.mkdir()
    lines = open(os.path.join(FIXTURES, "games.csv")).read().splitlines()
    (src / "a.csv").write_text("\n".join(lines[:4]) + "\n")
    out, ckpt = str(tmp_path / "by_event"), str(tmp_path / "ckpt_files")
    stream = read_games_stream(spark, str(src))
    start_keyed_stream(stream, C.avg_checks_by_event, "checks_files", sink="parquet",
                       path=out, checkpoint=ckpt, available_now=True).awaitTermination(120)
    (src / "b.csv").write_text("\n".join([lines[0]] + lines[4:]) + "\n")
    start_keyed_stream(stream, C.avg_checks_by_event, "checks_files", sink="parquet",
                       path=out, checkpoint=ckpt, available_now=True).awaitTermination(120)
    got = {r["event"]: r["avg_checks"] for r in spark.read.parquet(out).collect()}
    want = {r["event"]: r["avg_checks"] for r in C.avg_checks_by_event(games_csv).collect()}
    assert got == pytest.approx(want)


# Two shuffles at most: a join, or a sum by bins that is then joined by key.
TWO_SHUFFLES = {"draw_pct_by_opening_joined", "series_best_names", "series_all_names", "series_avg_max"}
# Several jobs with written tables between them: orders, chunks, files, roll-ups.
IN_STEPS = set(C.FILE_QUERIES) | {"series_name_chunks", "series_best_name_chunks", "series_name_index",
                                  "draw_share_ranked", "game_stats_rolled_up"}


@pytest.mark.parametrize("name", sorted(set(C.star_queries()) - IN_STEPS))
def test_one_shuffle_per_keyed_query(spark, name):
    """Every keyed query shuffles once, on its key (a sorted result adds one
    range exchange for the sort)."""
    plan = _plan(C.star_queries()[name](spark, SF_SMALL))
    hashed = plan.count("Exchange hashpartitioning")
    assert hashed == 1 if name not in TWO_SHUFFLES else 1 <= hashed <= 2
    assert plan.count("Exchange rangepartitioning") <= 1
