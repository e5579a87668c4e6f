"""Command line: run one catalogue query on a games or ratings file.

    python -m gamestats QUERY INPUT OUTPUT [options]
    python -m gamestats all-games INPUT OUTPUT_DIR [options]
    spark-submit gamestats/cli.py QUERY INPUT OUTPUT [options]

Game queries read games files (quoted CSV by default), measured once into a
derived table (see ``gamestats.sources.derived``); rating queries read the
tab-separated ratings layout, parsed once into such a table too, with the
rejected lines beside the rows.  The result is written one part per partition,
or as one ordered file with ``--single``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from gamestats.operators.best import SERIES_TYPE
from gamestats.plans.catalog import GAME_QUERIES, RATING_QUERIES, RESULT_ORDER, order_columns
from gamestats.sinks import show_rows, write_parts, write_single
from gamestats.sources.files import measured_games_table
from gamestats.sources.ledger import ratings_table, rows_of

ALL_GAMES = "all-games"
ALL_RATINGS = "all-ratings"


def run_query(spark: SparkSession, query: str, path: str, input_format: str = "csv",
              item_type: str = SERIES_TYPE) -> DataFrame:
    if query in RATING_QUERIES:
        return RATING_QUERIES[query](rows_of(ratings_table(spark, path)), item_type)
    return GAME_QUERIES[query](measured_games_table(spark, path, input_format))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m gamestats",
                                description="Run catalogue queries and write their results.")
    p.add_argument("query", choices=[ALL_GAMES, ALL_RATINGS]
                   + sorted(GAME_QUERIES) + sorted(RATING_QUERIES),
                   help=f"one query, or {ALL_GAMES} / {ALL_RATINGS} for every game / "
                        "rating query (each to OUTPUT/<query>)")
    p.add_argument("input", help="games file, folder or glob (ratings TSV for series_* queries)")
    p.add_argument("output", help="output folder")
    p.add_argument("--input-format", choices=["csv", "lines", "parquet"], default="csv",
                   help="games input: quoted CSV, naive comma split, or Parquet")
    p.add_argument("--item-type", default=SERIES_TYPE, help="item type kept by series_* queries")
    p.add_argument("--output-format", choices=["csv", "parquet", "json"], default="csv")
    p.add_argument("--single", action="store_true",
                   help="write one file, in the query's order (by key when it has none)")
    p.add_argument("--show", type=int, default=0, metavar="N", help="also print N rows")
    p.add_argument("--explain", action="store_true",
                   help="print the formatted physical plan before running")
    return p


def _write(df: DataFrame, query: str, output: str, fmt: str, single: bool) -> None:
    if single:
        order = RESULT_ORDER.get(query, [(df.columns[0], "asc")])
        write_single(df, output, fmt, sort_by=order_columns(order))
    else:
        write_parts(df, output, fmt)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"gamestats-{args.query}").getOrCreate()
    if args.query in (ALL_GAMES, ALL_RATINGS):
        # Every game query reads the same measured table, built once here.
        names = sorted(GAME_QUERIES if args.query == ALL_GAMES else RATING_QUERIES)
        targets = [(n, f"{args.output.rstrip('/')}/{n}") for n in names]
    else:
        targets = [(args.query, args.output)]
    for name, output in targets:
        df = run_query(spark, name, args.input, args.input_format, args.item_type)
        if args.explain:
            df.explain("formatted")
        if args.show:
            show_rows(df, args.show, truncate=False)
        _write(df, name, output, args.output_format, args.single)


if __name__ == "__main__":
    main()
