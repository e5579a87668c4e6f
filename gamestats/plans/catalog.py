"""The query catalogue (Q1-Q21 and their as-written variants).

Game queries take a measured-games frame (``games_from_star``,
``measure_games(read_games_csv(...))`` ...); rating queries take a ratings
frame ``(series, episode, rating, type)``.  Almost every query is one
declarative plan: scan -> column expressions -> partial aggregate -> shuffle on
the key -> final aggregate -> optional top-K / sort; the join form of the draw
percentage and the best-names query add one equi-join.  No Python runs per row.

Composite keys are grouped as separate columns; the ``#``-joined label is
built after the aggregation, on one row per group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.functions.measures import WHITE_WINS, captures, castled, checks, moves
from gamestats.operators.best import all_names, best_names, rated_items, summarise_group
from gamestats.operators.filters import with_result
from gamestats.operators.keyed import (keyed_mean, keyed_pct, keyed_ratio, mean_of,
                                       multi_keyed, pct_of, rolled_up, state_is_smaller)
from gamestats.operators.merge import best_items, chunk_index, name_chunks
from gamestats.operators.order import key_order, ranked
from gamestats.operators.ranking import sample_k, sort_by_key, top_k
from gamestats.operators.measured import measure_games
from gamestats.session import ensure_checkpoint_dir
from gamestats.sinks import publish, read_ordered, read_published, write_ordered
from gamestats.sources.exports import plain_games, quoted_games, tab_ratings
from gamestats.sources.files import read_games_lines
from gamestats.sources.incremental_table import measured_lines
from gamestats.sources.ledger import (ledger_counts, measured_ledger_table, ratings_table,
                                      rows_of)
from gamestats.sources.star import games_table, rated_items_table, rated_summary_table

KEY_SEPARATOR = "#"
# The item type kept by the rating queries on the events view.
RATED_TYPE = "purchase"
SAMPLE_SEED = 1
CHUNK_NAMES = 8  # names in a numbered chunk of a series


def _part(col: str) -> F.Column:
    """A part of a composite key; readers give NULL for an empty field."""
    return F.coalesce(F.col(col), F.lit("")).alias(col)


def _label(*cols: str) -> F.Column:
    return F.concat_ws(KEY_SEPARATOR, *[_part(c) for c in cols])


def _pct_by_pair(g: DataFrame, a: str, b: str, flag: str, label: str, alias: str) -> DataFrame:
    agg = g.groupBy(_part(a), _part(b)).agg(pct_of(flag).alias(alias))
    return agg.select(_label(a, b).alias(label), F.col(alias))


def _mean_by_pair(g: DataFrame, a: str, b: str, measure: str, label: str, alias: str) -> DataFrame:
    agg = g.groupBy(_part(a), _part(b)).agg(mean_of(measure).alias(alias))
    return agg.select(_label(a, b).alias(label), F.col(alias))


# --- means per key (A1) ---------------------------------------------------

def avg_moves_by_event(g: DataFrame) -> DataFrame:                       # Q1
    return keyed_mean(g, "event", "moves", "avg_moves")


def avg_captures_by_event(g: DataFrame) -> DataFrame:                    # Q2
    return keyed_mean(g, "event", "captures", "avg_captures")


def avg_captures_by_elo(g: DataFrame, band: str = "elo_band") -> DataFrame:  # Q3
    out = keyed_mean(g, F.col(band).alias("elo_band"), "captures", "avg_captures")
    return sort_by_key(out, "elo_band")


def avg_captures_by_moves(g: DataFrame) -> DataFrame:                    # Q4
    return sort_by_key(keyed_mean(g, "moves", "captures", "avg_captures"), "moves")


def avg_checks_by_event(g: DataFrame) -> DataFrame:                      # Q5
    return keyed_mean(g, "event", "checks", "avg_checks")


def avg_checks_by_elo(g: DataFrame) -> DataFrame:                        # Q6
    return keyed_mean(g, F.col("elo_band_black").alias("elo_band"), "checks", "avg_checks")


def avg_checks_by_moves(g: DataFrame) -> DataFrame:                      # Q7
    return keyed_mean(g, "moves", "checks", "avg_checks")


# --- percentages per opening (A2 + top-K, A3 + A4 + J1) -------------------

def draw_pct_by_opening_top50(g: DataFrame) -> DataFrame:                # Q8
    pct = _pct_by_pair(g, "eco", "opening", "draw", "eco_opening", "draw_pct")
    return top_k(pct, "draw_pct", 50, "eco_opening")


def white_win_pct_by_opening_top50(g: DataFrame) -> DataFrame:           # Q9
    pct = _pct_by_pair(g, "eco", "opening", "white_win", "eco_opening", "white_win_pct")
    return top_k(pct, "white_win_pct", 50, "eco_opening")


def draw_pct_by_opening(g: DataFrame) -> DataFrame:                      # Q10
    return _pct_by_pair(g, "eco", "opening", "draw", "eco_opening", "draw_pct")


def draw_pct_by_opening_joined(g: DataFrame) -> DataFrame:               # Q10, A5 + J1
    """The same from two totals joined on the key, the reference's form."""
    return keyed_ratio(g.withColumn("eco_opening", _label("eco", "opening")),
                       "eco_opening", "draw", "draw_pct")


def black_win_pct_by_opening(g: DataFrame) -> DataFrame:                 # Q21
    return _pct_by_pair(g, "eco", "opening", "black_win", "eco_opening", "black_win_pct")


# --- castling percentages (A2 [+ top-K]) -----------------------------------

def castling_pct_by_elo_top10(g: DataFrame, band: str = "elo_band",
                              flag: str = "castled") -> DataFrame:      # Q11
    pct = keyed_pct(g, F.col(band).alias("elo_band"), flag, "castling_pct")
    return top_k(pct, "castling_pct", 10, "elo_band")


def castling_pct_by_event_top50(g: DataFrame, flag: str = "castled") -> DataFrame:  # Q12
    return top_k(keyed_pct(g, "event", flag, "castling_pct"), "castling_pct", 50, "event")


def castling_pct_by_moves(g: DataFrame, flag: str = "castled") -> DataFrame:        # Q13
    return keyed_pct(g, "moves", flag, "castling_pct")


# --- shares per opening and event (A1 on flags, sample, A8) ----------------

def draw_share_by_opening_event(g: DataFrame) -> DataFrame:              # Q14
    return _mean_by_pair(g, "opening", "event", "draw", "opening_event", "draw_share")


def draw_share_sample10(g: DataFrame) -> DataFrame:                      # Q15
    return sample_k(draw_share_by_opening_event(g), "opening_event", 10, SAMPLE_SEED)


def draw_share_ranked(g: DataFrame) -> DataFrame:                       # Q15, O2 as drafted
    """The shares in falling order of their key, with their positions."""
    return ranked(draw_share_by_opening_event(g), key_order("opening_event", descending=True))


def white_win_share_by_opening_event(g: DataFrame) -> DataFrame:         # Q16
    return _mean_by_pair(g, "opening", "event", "white_win", "opening_event",
                         "white_win_share")


def white_wins_by_opening_event(g: DataFrame) -> DataFrame:              # Q16, as drafted
    """The draft's own steps: keep the games white won (F2), then aggregate per
    opening#event; the count is the aggregate that is defined on those rows.
    The filter reaches the Parquet scan of the games table."""
    wins = with_result(g, WHITE_WINS).groupBy(_part("opening"), _part("event")).agg(
        F.count(F.lit(1)).alias("white_wins"))
    return wins.select(_label("opening", "event").alias("opening_event"), "white_wins")


# --- all keys over one scan (A9) -------------------------------------------

GROUPING_SETS = {
    "event": ("event",),
    "elo_band": ("elo_band",),
    "moves": ("moves",),
    "opening_event": ("opening", "event"),
}


def game_stats_aggregates() -> dict[str, F.Column]:
    return {
        "games": F.count(F.lit(1)),
        "avg_moves": mean_of("moves"),
        "avg_captures": mean_of("captures"),
        "avg_checks": mean_of("checks"),
        "castling_share": mean_of("castled"),
        "draw_share": mean_of("draw"),
        "white_win_share": mean_of("white_win"),
    }


def game_stats_grouping_sets(g: DataFrame) -> DataFrame:                 # Q17
    """Every measure per event, per band (of the mean rating, as in the
    reference's combined draft), per length and per opening#event, from one
    scan: one Expand, one partial and one final aggregation."""
    g = g.withColumn("elo_band", F.col("elo_band_mean"))
    out = multi_keyed(g, GROUPING_SETS, game_stats_aggregates())
    # Key columns are labels here (NULL where a set does not group by them);
    # the length is given as text so every key column has one type.
    return out.withColumn("moves", F.col("moves").cast("string"))


GAME_STATS_MEANS = {"avg_moves": "moves", "avg_captures": "captures", "avg_checks": "checks",
                    "castling_share": "castled", "draw_share": "draw", "white_win_share": "white_win"}


def game_stats_rolled_up(g: DataFrame) -> DataFrame:                     # Q17, one small state
    """The same rows added up from one state per combination of keys, where that
    is smaller than the copies that grouping sets make of the games."""
    g = g.withColumn("elo_band", F.col("elo_band_mean"))
    if not state_is_smaller(g, GROUPING_SETS):
        return game_stats_grouping_sets(g)
    return rolled_up(g, GROUPING_SETS, GAME_STATS_MEANS).withColumn("moves", F.col("moves").cast("string"))


# --- rated items per group --------------------------------------------------

def series_avg_max(r: DataFrame, item_type: str = RATED_TYPE) -> DataFrame:      # Q18
    return summarise_group(rated_items(r, item_type), "series", "rating")


def series_all_names(r: DataFrame, item_type: str = RATED_TYPE,
                     summary: DataFrame | None = None) -> DataFrame:             # Q19
    return all_names(rated_items(r, item_type), "series", "rating", "episode", summary)


def series_best_names(r: DataFrame, item_type: str = RATED_TYPE,
                      summary: DataFrame | None = None) -> DataFrame:            # Q20
    return best_names(rated_items(r, item_type), "series", "rating", "episode", summary)


def series_name_chunks(r: DataFrame, item_type: str = RATED_TYPE) -> DataFrame:  # Q19, A7 in chunks
    return name_chunks(rated_items(r, item_type), "series", "episode", CHUNK_NAMES)


def series_name_index(r: DataFrame, item_type: str = RATED_TYPE) -> DataFrame:
    """How many names, chunks and characters the merged text of a series has."""
    return chunk_index(series_name_chunks(r, item_type), "series")


def series_best_name_chunks(r: DataFrame, item_type: str = RATED_TYPE) -> DataFrame:  # Q20, J5 + A7
    best = best_items(rated_items(r, item_type), "series", "rating", "episode")
    return name_chunks(best, "series", "episode", CHUNK_NAMES)


def text_measures_by_lang(docs: DataFrame) -> DataFrame:
    """The move-text measures on any texts (``lang``, ``text``): totals per
    language, the move count and the castling flag in both their forms."""
    found = {"dots": moves("text"), "numbered": moves("text", "numbered"),
             "captures": captures("text"), "checks": checks("text"),
             "castled": castled("text"), "castled_dash": castled("text", "dash")}
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"),
                                    *[F.sum(c).alias(n) for n, c in found.items()])


GAME_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "avg_moves_by_event": avg_moves_by_event,
    "avg_captures_by_event": avg_captures_by_event,
    "avg_captures_by_elo": avg_captures_by_elo,
    "avg_captures_by_elo_text": lambda g: avg_captures_by_elo(g, "elo_band_text"),
    "avg_captures_by_moves": avg_captures_by_moves,
    "avg_checks_by_event": avg_checks_by_event,
    "avg_checks_by_elo": avg_checks_by_elo,
    "avg_checks_by_moves": avg_checks_by_moves,
    "draw_pct_by_opening_top50": draw_pct_by_opening_top50,
    "white_win_pct_by_opening_top50": white_win_pct_by_opening_top50,
    "draw_pct_by_opening": draw_pct_by_opening,
    "draw_pct_by_opening_joined": draw_pct_by_opening_joined,
    "castling_pct_by_elo_top10": castling_pct_by_elo_top10,
    "castling_pct_by_elo_top10_text": lambda g: castling_pct_by_elo_top10(g, "elo_band_text"),
    "castling_pct_by_elo_top10_dash": lambda g: castling_pct_by_elo_top10(g, flag="castled_dash"),
    "castling_pct_by_event_top50": castling_pct_by_event_top50,
    "castling_pct_by_event_top50_dash": lambda g: castling_pct_by_event_top50(g, "castled_dash"),
    "castling_pct_by_moves": castling_pct_by_moves,
    "castling_pct_by_moves_dash": lambda g: castling_pct_by_moves(g, "castled_dash"),
    "draw_share_by_opening_event": draw_share_by_opening_event,
    "draw_share_sample10": draw_share_sample10,
    "draw_share_ranked": draw_share_ranked,
    "white_win_share_by_opening_event": white_win_share_by_opening_event,
    "white_wins_by_opening_event": white_wins_by_opening_event,
    "game_stats_grouping_sets": game_stats_grouping_sets,
    "game_stats_rolled_up": game_stats_rolled_up,
    "black_win_pct_by_opening": black_win_pct_by_opening,
}

RATING_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "series_avg_max": series_avg_max,
    "series_all_names": series_all_names,
    "series_best_names": series_best_names,
    "series_name_chunks": series_name_chunks,
    "series_name_index": series_name_index,
    "series_best_name_chunks": series_best_name_chunks,
}

# Those that take the summary of the series, where it is a table already.
WITH_SUMMARY = ("series_all_names", "series_best_names")


# --- through files and sinks (S1-S4, M8, K1-K3, K6, R2) ----------------------

RESULTS_FOLDER = "gamestats-results"


def _result_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A published result of its own for each input folder."""
    digest = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{RESULTS_FOLDER}/{name}-{digest}"


def _quoted(query: Callable[[DataFrame], DataFrame]):
    return lambda spark, d: query(rows_of(measured_ledger_table(spark, quoted_games(spark, d))))


def _plain(query: Callable[[DataFrame], DataFrame]):
    return lambda spark, d: query(measure_games(read_games_lines(spark, plain_games(spark, d))))


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(ratings_table(spark, tab_ratings(spark, sf_dir)))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the ratings files, all files together: what was read, kept
    and rejected for which reason, and how many rejects name their line."""
    ledger = ratings_table(spark, tab_ratings(spark, sf_dir)).withColumn("input", F.lit("ratings"))
    named = F.coalesce((F.col("file") != "") & (F.col("number") > 0) & F.col("text").isNotNull(), F.lit(False))
    places = ledger.where(F.col("reason").isNotNull()).groupBy("input").agg(
        F.sum(named.cast("long")).alias("named"), F.countDistinct("file", "number").alias("places"))
    return ledger_counts(ledger, "input").join(places, "input", "left").drop("input", "rejected_record")


def _published_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11's top list written as a new version of a result, and read back (K1, K6)."""
    path = _result_path(spark, sf_dir, "castling-top10")
    publish(castling_pct_by_elo_top10(games_table(spark, sf_dir)), path)
    return read_published(spark, path)


def _ordered_by_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 written in order, in parts, and read back with positions (K2, K3, R2)."""
    path = _result_path(spark, sf_dir, "captures-by-moves")
    write_ordered(keyed_mean(games_table(spark, sf_dir), "moves", "captures", "avg_captures"), path, "moves")
    return read_ordered(spark, path)


def _by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on a table that follows its files one by one (R1)."""
    table = measured_lines(spark, plain_games(spark, sf_dir))
    table.refresh()
    return avg_captures_by_event(table.table())


FILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quoted_avg_captures_by_event": _quoted(avg_captures_by_event),
    "quoted_avg_captures_by_moves": _quoted(avg_captures_by_moves),
    "quoted_avg_captures_by_elo": _quoted(avg_captures_by_elo),
    "quoted_draw_share_ranked": _quoted(draw_share_ranked),
    "plain_avg_captures_by_event": _plain(avg_captures_by_event),
    "by_file_avg_captures_by_event": _by_file,
    "tab_series_avg_max": lambda spark, d: series_avg_max(_ratings(spark, d)),
    "tab_series_best_names": lambda spark, d: series_best_names(_ratings(spark, d)),
    "tab_rejects": _rejects,
    "castling_pct_by_elo_top10_published": _published_top10,
    "avg_captures_by_moves_ordered": _ordered_by_moves,
}


def _top_order(value: str, key: str) -> list[tuple[str, str]]:
    return [(value, "desc"), (key, "asc")]


# The row order of the queries whose result is ordered (sorted by key, or
# ranked by value), as (column, direction) with NULLs last; used when a result
# is written as one ordered file.
RESULT_ORDER: dict[str, list[tuple[str, str]]] = {
    "avg_captures_by_elo": [("elo_band", "asc")],
    "avg_captures_by_elo_text": [("elo_band", "asc")],
    "avg_captures_by_moves": [("moves", "asc")],
    "draw_pct_by_opening_top50": _top_order("draw_pct", "eco_opening"),
    "white_win_pct_by_opening_top50": _top_order("white_win_pct", "eco_opening"),
    "castling_pct_by_elo_top10": _top_order("castling_pct", "elo_band"),
    "castling_pct_by_elo_top10_text": _top_order("castling_pct", "elo_band"),
    "castling_pct_by_elo_top10_dash": _top_order("castling_pct", "elo_band"),
    "castling_pct_by_event_top50": _top_order("castling_pct", "event"),
    "castling_pct_by_event_top50_dash": _top_order("castling_pct", "event"),
}


def order_columns(order: list[tuple[str, str]]) -> list[F.Column]:
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last()
            for c, d in order]


def star_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every catalogue query as ``(spark, sf_dir) -> DataFrame`` over the
    star-schema views.  Game queries read the measured-games table, which is
    derived from ``orders`` + ``lineitem`` once per input and reused; rating
    queries read the rated items of ``events``, also written once; the file
    queries read the same views exported as text files; the text measures read
    ``documents``."""
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name, q in GAME_QUERIES.items():
        out[name] = (lambda q: lambda spark, d: q(games_table(spark, d)))(q)
    for name, q in RATING_QUERIES.items():
        out[name] = (lambda q: lambda spark, d: q(rated_items_table(spark, d, RATED_TYPE)))(q)
    for name in WITH_SUMMARY:
        out[name] = (lambda q: lambda spark, d: q(
            rated_items_table(spark, d, RATED_TYPE), RATED_TYPE,
            rated_summary_table(spark, d, RATED_TYPE)))(RATING_QUERIES[name])
    out.update(FILE_QUERIES)
    out["text_measures_by_lang"] = lambda spark, d: text_measures_by_lang(
        spark.read.parquet(f"{d.rstrip('/')}/documents.parquet"))
    return out
