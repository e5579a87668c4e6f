"""The games-file path checked in a second engine: DuckDB reads the CSV
fixture and computes every per-game measure and band with its own string
functions; Spark's measured games must agree game by game."""

import os

import duckdb

from gamestats.plans.oracle import band_sql

from conftest import FIXTURES

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _count(ch):
    return f"(length(coalesce(an, '')) - length(replace(coalesce(an, ''), '{ch}', '')))"


def test_measured_csv_games_equal_duckdb(games_csv):
    path = os.path.join(FIXTURES, "games.csv")
    sql = f"""
    WITH g AS (SELECT * FROM read_csv('{path}', header = true, all_varchar = true, quote = '"')),
    t AS (SELECT *, TRY_CAST(white_elo AS INTEGER) AS w, TRY_CAST(black_elo AS INTEGER) AS b FROM g)
    SELECT CAST(id AS BIGINT) AS id, trim(event, {WS}) AS event, trim(opening, {WS}) AS opening,
           CAST({_count('.')} AS BIGINT) AS moves,
           CAST(len(regexp_extract_all(regexp_replace(coalesce(an, ''), '\\{{[^}}]*\\}}', '', 'g'),
                                       '\\d+\\. ')) AS BIGINT) AS moves_numbered,
           CAST({_count('x')} AS BIGINT) AS captures,
           CAST({_count('+')} - CASE WHEN contains(coalesce(an, ''), '++') THEN 1 ELSE 0 END
                AS BIGINT) AS checks,
           CASE WHEN contains(coalesce(an, ''), 'O-O') THEN 1 ELSE 0 END AS castled,
           CASE WHEN contains(coalesce(an, ''), '-') THEN 1 ELSE 0 END AS castled_dash,
           CASE WHEN result = '1/2-1/2' THEN 1 ELSE 0 END AS draw,
           CASE WHEN result = '1-0' THEN 1 ELSE 0 END AS white_win,
           CASE WHEN result = '0-1' THEN 1 ELSE 0 END AS black_win,
           {band_sql('greatest(w, b)')} AS elo_band,
           {band_sql('greatest(white_elo, black_elo)', as_text=True)} AS elo_band_text,
           {band_sql('((w + b) / 2.0)')} AS elo_band_mean,
           {band_sql('(CASE WHEN w IS NULL THEN b ELSE (w + b) / 2.0 END)')} AS elo_band_black
    FROM t ORDER BY id"""
    con = duckdb.connect()
    rel = con.sql(sql)
    cols = rel.columns
    duck = [dict(zip(cols, r)) for r in rel.fetchall()]

    from gamestats.operators.measured import measure_games
    from gamestats.sources.files import read_games_csv

    numbered = measure_games(read_games_csv(games_csv.sparkSession, path), "numbered")
    spark_rows = {r["id"]: r.asDict() for r in games_csv.collect()}
    spark_numbered = {r["id"]: r["moves"] for r in numbered.collect()}
    assert len(duck) == len(spark_rows) == 7
    for d in duck:
        s = spark_rows[d["id"]]
        for c in cols:
            if c == "moves_numbered":
                assert spark_numbered[d["id"]] == d[c], (d["id"], c)
            else:
                assert s[c] == d[c], (d["id"], c, s[c], d[c])
