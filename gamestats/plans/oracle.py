"""Independent SQL for every catalogue query, runnable by DuckDB on the
driver's tables (views ``orders``, ``lineitem``, ``events``).

The games view here is built the long way: each order's move text is
assembled with an ordered ``string_agg`` and the measures are counted on that
text.  The Spark side never builds the text (it sums per line item), so a
match checks the additivity argument as well as the queries.
"""

from __future__ import annotations

# Written out here, not imported, so that a change of the Spark code shows.
BAND_EDGES = (1200, 1400, 1600, 1800, 2000, 2200, 2300, 2400, 2500, 2700)
BAND_NAMES = ("novice", "class D", "class C", "class B", "class A", "CM",
              "CM-NM", "FM-IM", "IM-GM", "GM", "SGM")
CHUNK_NAMES = 8
DIRTY_EVERY = 50
NAME_SEPARATOR = " | "
RATED_TYPE = "purchase"
SAMPLE_SEED = 1
GROUPING_SETS = {"event": ("event",), "elo_band": ("elo_band",), "moves": ("moves",),
                 "opening_event": ("opening", "event")}

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def band_sql(value: str, as_text: bool = False) -> str:
    whens = " ".join(
        f"WHEN {value} < {repr(str(e)) if as_text else e} THEN '{n}'"
        for e, n in zip(BAND_EDGES, BAND_NAMES))
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{BAND_NAMES[-1]}' END"


def _count(text: str, ch: str) -> str:
    return f"(length({text}) - length(replace({text}, '{ch}', '')))"


GAMES_CTE = f"""
li AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CAST(l_linenumber AS VARCHAR) || '. ' ||
         CASE WHEN l_returnflag = 'R' THEN 'Nxe5'
              WHEN l_returnflag = 'A' AND l_quantity >= 45 THEN 'Rxe8++'
              WHEN l_returnflag = 'A' THEN 'Qh5+'
              WHEN l_linestatus = 'O' THEN 'O-O'
              ELSE 'e4' END AS frag
  FROM lineitem),
per_order AS (
  SELECT l_orderkey, min(l_suppkey) AS black_key,
         string_agg(frag, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS an
  FROM li GROUP BY l_orderkey),
raw_games AS (
  SELECT o.o_orderkey AS id,
         ' ' || o.o_orderpriority || ' ' AS event,
         'c' || CAST(o.o_custkey AS VARCHAR) AS white,
         's' || CAST(p.black_key AS VARCHAR) AS black,
         CASE o.o_orderstatus WHEN 'F' THEN '1-0' WHEN 'O' THEN '0-1'
                              WHEN 'P' THEN '1/2-1/2' END AS result,
         CASE WHEN o.o_custkey % 97 = 0 THEN '?'
              ELSE CAST(800 + (o.o_custkey * 37) % 2100 AS VARCHAR) END AS white_elo,
         CAST(800 + (p.black_key * 53) % 2100 AS VARCHAR) AS black_elo,
         'C' || lpad(CAST(o.o_orderkey % 40 AS VARCHAR), 2, '0') AS eco,
         'Opening ' || CAST(o.o_orderkey % 7 AS VARCHAR) AS opening,
         coalesce(p.an, '') AS an
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey),
typed AS (
  SELECT *, TRY_CAST(white_elo AS INTEGER) AS w, TRY_CAST(black_elo AS INTEGER) AS b
  FROM raw_games),
games AS (
  SELECT id, trim(event, {WS}) AS event, white, black, result, white_elo, black_elo,
         eco, trim(opening, {WS}) AS opening,
         CAST({_count('an', '.')} AS BIGINT) AS moves,
         CAST({_count('an', 'x')} AS BIGINT) AS captures,
         CAST({_count('an', '+')} - CASE WHEN contains(an, '++') THEN 1 ELSE 0 END AS BIGINT) AS checks,
         CASE WHEN contains(an, 'O-O') THEN 1 ELSE 0 END AS castled,
         CASE WHEN contains(an, '-') THEN 1 ELSE 0 END AS castled_dash,
         CASE WHEN result = '1/2-1/2' THEN 1 ELSE 0 END AS draw,
         CASE WHEN result = '1-0' THEN 1 ELSE 0 END AS white_win,
         CASE WHEN result = '0-1' THEN 1 ELSE 0 END AS black_win,
         {band_sql('greatest(w, b)')} AS elo_band,
         {band_sql('greatest(white_elo, black_elo)', as_text=True)} AS elo_band_text,
         {band_sql('((w + b) / 2.0)')} AS elo_band_mean,
         {band_sql('(CASE WHEN w IS NULL THEN b ELSE (w + b) / 2.0 END)')} AS elo_band_black
  FROM typed)
"""

RATINGS_CTE = f"""
items AS (
  SELECT CAST(user_id AS VARCHAR) AS series, CAST(event_id AS VARCHAR) AS episode,
         value AS rating, event_type AS type
  FROM events
  WHERE event_type = '{RATED_TYPE}' AND event_id IS NOT NULL
    AND CAST(event_id AS VARCHAR) <> 'null')
"""


# The exact sum of the ratings as a whole number of 2 ** -80 (they are all such
# multiples), rounded once: its 58 or so highest bits, then one bit for the rest.
EXACT_CTE = """
units AS (
  SELECT series, count(rating) AS n, max(rating) AS max_rating,
         sum(CAST(rating * 1208925819614629174706176 AS HUGEINT)) AS u
  FROM items GROUP BY series),
cut AS (
  SELECT *, greatest(0, CAST(floor(log2(CAST(abs(u) AS DOUBLE) + 1)) AS INTEGER) - 58) AS k,
         CAST(pow(2, greatest(0, CAST(floor(log2(CAST(abs(u) AS DOUBLE) + 1)) AS INTEGER) - 58)) AS HUGEINT) AS p
  FROM units),
summary AS (
  SELECT series, max_rating, n,
         sign(u) * CAST(CAST((abs(u) // p) * 2 + CASE WHEN abs(u) % p <> 0 THEN 1 ELSE 0 END AS BIGINT)
                        AS DOUBLE) * pow(2, k - 81) / n AS avg_rating
  FROM cut)
"""


def _games(body: str) -> str:
    return f"WITH {GAMES_CTE}\n{body}"


def _ratings(body: str) -> str:
    return f"WITH {RATINGS_CTE}, {EXACT_CTE}\n{body}"


def _mean(col: str) -> str:
    return f"avg(CAST({col} AS DOUBLE))"


def _pct(col: str) -> str:
    return f"avg(CAST({col} AS DOUBLE)) * CAST(100 AS DOUBLE)"


def _keyed(key: str, agg: str, alias: str, order_limit: str = "") -> str:
    return _games(f"SELECT {key}, {agg} AS {alias} FROM games GROUP BY {key} {order_limit}")


def _band_keyed(band: str, agg: str, alias: str, order_limit: str = "") -> str:
    return _games(f"SELECT {band} AS elo_band, {agg} AS {alias} FROM games "
                  f"GROUP BY {band} {order_limit}")


def _pair(a: str, b: str, agg: str, label: str, alias: str, order_limit: str = "") -> str:
    return _games(f"SELECT coalesce({a}, '') || '#' || coalesce({b}, '') AS {label}, {agg} AS {alias} "
                  f"FROM games GROUP BY coalesce({a}, ''), coalesce({b}, '') {order_limit}")


def _top(value: str, key: str, k: int) -> str:
    return f"ORDER BY {value} DESC NULLS LAST, {key} ASC NULLS LAST LIMIT {k}"


def _grouping_sets_sql() -> str:
    keys: list[str] = []
    for members in GROUPING_SETS.values():
        keys += [k for k in members if k not in keys]
    n = len(keys)
    label = "CASE GROUPING(" + ", ".join(keys) + ")"
    for name, members in GROUPING_SETS.items():
        code = sum(1 << (n - 1 - i) for i, k in enumerate(keys) if k not in members)
        label += f" WHEN {code} THEN '{name}'"
    label += " END"
    sets = ", ".join("(" + ", ".join(m) + ")" for m in GROUPING_SETS.values())
    key_cols = [f"CAST({k} AS VARCHAR) AS {k}" if k == "moves" else k for k in keys]
    return _games(f"""
SELECT {label} AS grouping_set, {', '.join(key_cols)},
       count(*) AS games,
       {_mean('moves')} AS avg_moves, {_mean('captures')} AS avg_captures,
       {_mean('checks')} AS avg_checks, {_mean('castled')} AS castling_share,
       {_mean('draw')} AS draw_share, {_mean('white_win')} AS white_win_share
FROM (SELECT * REPLACE (elo_band_mean AS elo_band) FROM games) g
GROUP BY GROUPING SETS ({sets})""")


def _draw_share_sql() -> str:
    return _pair("opening", "event", _mean("draw"), "opening_event", "draw_share")


def _chunks_sql(items: str) -> str:
    return f"""
SELECT series, place // {CHUNK_NAMES} AS chunk, min(place) AS first_place, count(*) AS n_names,
       string_agg(episode, '{NAME_SEPARATOR}' ORDER BY place) AS names
FROM (SELECT series, episode, row_number() OVER (PARTITION BY series ORDER BY episode) - 1 AS place
      FROM {items})
GROUP BY series, place // {CHUNK_NAMES}"""


def _ranked_sql() -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY opening_event DESC NULLS LAST) AS position "
            f"FROM ({_draw_share_sql()})")


def _tab(body: str) -> str:
    """Ratings as the tab-separated files have them, without the dirty lines."""
    items = RATINGS_CTE.replace("CAST(user_id AS VARCHAR) AS series",
                                "user_id || '#' || (user_id % 7) || '#s' AS series")
    items = items.replace("WHERE ", f"WHERE event_id % {DIRTY_EVERY} > 2 AND ")
    return f"WITH {items}, {EXACT_CTE}\n{body}"


def _file_sql(star: dict[str, str]) -> dict[str, str]:
    best = star["series_best_names"]
    return {
        **{f"quoted_{q}": star[q] for q in ("avg_captures_by_event", "avg_captures_by_moves",
                                            "avg_captures_by_elo", "draw_share_ranked")},
        "plain_avg_captures_by_event": star["avg_captures_by_event"],
        "by_file_avg_captures_by_event": star["avg_captures_by_event"],
        "tab_series_avg_max": _tab("SELECT series, avg_rating, max_rating FROM summary"),
        "tab_series_best_names": _tab(best[best.index("\nSELECT series, string_agg"):]),
        "tab_rejects": f"""
WITH e AS (SELECT event_id % {DIRTY_EVERY} AS d FROM events)
SELECT count(*) AS records, count(*) FILTER (WHERE d > 2) AS rows, count(*) FILTER (WHERE d <= 2) AS rejects,
       count(*) FILTER (WHERE d = 1) AS rejected_fields, count(*) FILTER (WHERE d = 0) AS rejected_rating,
       count(*) FILTER (WHERE d = 2) AS rejected_not_finite,
       count(*) FILTER (WHERE d <= 2) AS named, count(*) FILTER (WHERE d <= 2) AS places
FROM e""",
        "castling_pct_by_elo_top10_published": star["castling_pct_by_elo_top10"],
        "avg_captures_by_moves_ordered": (
            f"SELECT *, row_number() OVER (ORDER BY moves NULLS LAST) AS position "
            f"FROM ({star['avg_captures_by_moves']})"),
    }


def oracle_sql() -> dict[str, str]:
    star = _star_sql()
    return {**star, **_file_sql(star)}


def _star_sql() -> dict[str, str]:
    return {
        "avg_moves_by_event": _keyed("event", _mean("moves"), "avg_moves"),
        "avg_captures_by_event": _keyed("event", _mean("captures"), "avg_captures"),
        "avg_captures_by_elo": _band_keyed("elo_band", _mean("captures"), "avg_captures"),
        "avg_captures_by_elo_text": _band_keyed("elo_band_text", _mean("captures"),
                                                "avg_captures"),
        "avg_captures_by_moves": _keyed("moves", _mean("captures"), "avg_captures",
                                        "ORDER BY moves"),
        "avg_checks_by_event": _keyed("event", _mean("checks"), "avg_checks"),
        "avg_checks_by_elo": _band_keyed("elo_band_black", _mean("checks"), "avg_checks"),
        "avg_checks_by_moves": _keyed("moves", _mean("checks"), "avg_checks"),
        "draw_pct_by_opening_top50": _pair("eco", "opening", _pct("draw"), "eco_opening",
                                           "draw_pct", _top("draw_pct", "eco_opening", 50)),
        "white_win_pct_by_opening_top50": _pair(
            "eco", "opening", _pct("white_win"), "eco_opening", "white_win_pct",
            _top("white_win_pct", "eco_opening", 50)),
        "draw_pct_by_opening": _pair("eco", "opening", _pct("draw"), "eco_opening", "draw_pct"),
        "draw_pct_by_opening_joined": _games(
            "SELECT eco_opening, CAST(sum(draw) AS DOUBLE) / count(*) * CAST(100 AS DOUBLE) "
            "AS draw_pct FROM (SELECT coalesce(eco, '') || '#' || coalesce(opening, '') "
            "AS eco_opening, draw FROM games) GROUP BY eco_opening"),
        "castling_pct_by_elo_top10": _band_keyed(
            "elo_band", _pct("castled"), "castling_pct", _top("castling_pct", "elo_band", 10)),
        "castling_pct_by_elo_top10_text": _band_keyed(
            "elo_band_text", _pct("castled"), "castling_pct",
            _top("castling_pct", "elo_band", 10)),
        "castling_pct_by_elo_top10_dash": _band_keyed(
            "elo_band", _pct("castled_dash"), "castling_pct",
            _top("castling_pct", "elo_band", 10)),
        "castling_pct_by_event_top50": _keyed("event", _pct("castled"), "castling_pct",
                                              _top("castling_pct", "event", 50)),
        "castling_pct_by_event_top50_dash": _keyed(
            "event", _pct("castled_dash"), "castling_pct", _top("castling_pct", "event", 50)),
        "castling_pct_by_moves": _keyed("moves", _pct("castled"), "castling_pct"),
        "castling_pct_by_moves_dash": _keyed("moves", _pct("castled_dash"), "castling_pct"),
        "draw_share_by_opening_event": _draw_share_sql(),
        "draw_share_sample10": (
            "SELECT opening_event, draw_share FROM (" + _draw_share_sql() + ") q "
            f"ORDER BY md5(opening_event || '#{SAMPLE_SEED}') ASC NULLS LAST, "
            "opening_event ASC NULLS LAST LIMIT 10"),
        "draw_share_ranked": _ranked_sql(),
        "white_win_share_by_opening_event": _pair(
            "opening", "event", _mean("white_win"), "opening_event", "white_win_share"),
        "white_wins_by_opening_event": _games(
            "SELECT coalesce(opening, '') || '#' || coalesce(event, '') AS opening_event, "
            "count(*) AS white_wins FROM games WHERE result = '1-0' "
            "GROUP BY coalesce(opening, ''), coalesce(event, '')"),
        "game_stats_grouping_sets": _grouping_sets_sql(),
        "game_stats_rolled_up": _grouping_sets_sql(),
        "black_win_pct_by_opening": _pair("eco", "opening", _pct("black_win"), "eco_opening",
                                          "black_win_pct"),
        "series_avg_max": _ratings("SELECT series, avg_rating, max_rating FROM summary"),
        "series_all_names": _ratings(f"""
SELECT series, string_agg(episode, '{NAME_SEPARATOR}' ORDER BY episode) AS names,
       any_value(s.max_rating) AS max_rating, any_value(s.avg_rating) AS avg_rating
FROM items JOIN summary s USING (series) GROUP BY series"""),
        "series_best_names": _ratings(f"""
SELECT series, string_agg(episode, '{NAME_SEPARATOR}' ORDER BY episode) AS best_names,
       any_value(s.max_rating) AS max_rating, any_value(s.avg_rating) AS avg_rating
FROM items JOIN summary s USING (series) WHERE rating = s.max_rating GROUP BY series"""),
        "series_name_chunks": _ratings(_chunks_sql("items")),
        "series_best_name_chunks": _ratings(_chunks_sql(
            "(SELECT i.* FROM items i JOIN summary s USING (series) WHERE i.rating = s.max_rating)")),
        "series_name_index": _ratings(f"""
SELECT series, CAST(count(*) AS BIGINT) AS n_names,
       CAST((count(*) + {CHUNK_NAMES - 1}) // {CHUNK_NAMES} AS BIGINT) AS n_chunks,
       CAST(length(string_agg(episode, '{NAME_SEPARATOR}')) AS BIGINT) AS n_chars
FROM items GROUP BY series"""),
        "text_measures_by_lang": f"""
WITH t AS (SELECT lang, coalesce(text, '') AS an FROM documents)
SELECT lang, count(*) AS texts,
       CAST(sum({_count('an', '.')}) AS BIGINT) AS dots,
       CAST(sum(len(regexp_extract_all(regexp_replace(an, '\\{{[^}}]*\\}}', '', 'g'),
                                       '[0-9]+\\. '))) AS BIGINT) AS numbered,
       CAST(sum({_count('an', 'x')}) AS BIGINT) AS captures,
       CAST(sum({_count('an', '+')} - CASE WHEN contains(an, '++') THEN 1 ELSE 0 END) AS BIGINT)
         AS checks,
       CAST(sum(CASE WHEN contains(an, 'O-O') THEN 1 ELSE 0 END) AS BIGINT) AS castled,
       CAST(sum(CASE WHEN contains(an, '-') THEN 1 ELSE 0 END) AS BIGINT) AS castled_dash
FROM t GROUP BY lang""",
    }
