"""
registered queries; kept as a test so the map cannot go stale."""

import __spark_entry__ as E
from gamestats.plans import catalog
from gamestats.plans.oracle import oracle_sql

QUERIES = {
    "Q1": "avg_moves_by_event", "Q2": "avg_captures_by_event", "Q3": "avg_captures_by_elo",
    "Q4": "avg_captures_by_moves", "Q5": "avg_checks_by_event", "Q6": "avg_checks_by_elo",
    "Q7": "avg_checks_by_moves", "Q8": "draw_pct_by_opening_top50",
    "Q9": "white_win_pct_by_opening_top50", "Q10": "draw_pct_by_opening",
    "Q11": "castling_pct_by_elo_top10", "Q12": "castling_pct_by_event_top50",
    "Q13": "castling_pct_by_moves", "Q14": "draw_share_by_opening_event",
    "Q15": "draw_share_sample10", "Q16": "white_win_share_by_opening_event",
    "Q17": "game_stats_grouping_sets", "Q18": "series_avg_max", "Q19": "series_all_names",
    "Q20": "series_best_names", "Q21": "black_win_pct_by_opening",
}
OTHER_FORMS = ["avg_captures_by_elo_text", "castling_pct_by_elo_top10_text",
              "castling_pct_by_elo_top10_dash", "castling_pct_by_event_top50_dash",
              "castling_pct_by_moves_dash", "white_wins_by_opening_event",
              "draw_pct_by_opening_joined", "text_measures_by_lang", "series_name_chunks",
              "series_name_index", "series_best_name_chunks", "draw_share_ranked",
              "game_stats_rolled_up", *catalog.FILE_QUERIES]


def test_every_catalogue_query_is_registered_with_sql():
    registered, sql = catalog.star_queries(), oracle_sql()
    names = list(QUERIES.values()) + OTHER_FORMS
    assert sorted(names) == sorted(registered) == sorted(sql)
    assert set(registered) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())
