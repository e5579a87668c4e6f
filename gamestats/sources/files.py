"""File readers (S1-S4): games as CSV / naive text split / Parquet, ratings as TSV.

Every reader takes a path (local, HDFS or object-store URI; a directory or a
glob reads all its parts in parallel) and declares its schema, so no job is
spent on schema inference and Parquet scans get column pruning and pushed
filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Games: one game per row.  Ratings stay text here; they are parsed with
# try_cast where they are used, so the raw text is still there for the
# text-compared band.
GAMES_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("event", StringType()),
    StructField("white", StringType()),
    StructField("black", StringType()),
    StructField("result", StringType()),
    StructField("white_elo", StringType()),
    StructField("black_elo", StringType()),
    StructField("eco", StringType()),
    StructField("opening", StringType()),
    StructField("time_control", StringType()),
    StructField("termination", StringType()),
    StructField("an", StringType()),
])
GAMES_COLUMNS = tuple(f.name for f in GAMES_SCHEMA.fields)

# Ratings: only positions 2..7 are meaningful; the first two are carried as text.
RATINGS_SCHEMA = StructType([
    StructField("col0", StringType()),
    StructField("col1", StringType()),
    StructField("rating_text", StringType()),
    StructField("series_a", StringType()),
    StructField("series_b", StringType()),
    StructField("series_c", StringType()),
    StructField("type", StringType()),
    StructField("episode", StringType()),
])


def read_games_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Quoted CSV (a quoted opening may hold commas).  Malformed rows are kept
    with NULLs in the fields that do not parse (PERMISSIVE)."""
    return (spark.read.schema(GAMES_SCHEMA)
            .option("header", header)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_games_lines(spark: SparkSession, path: str) -> DataFrame:
    """The reference's reader, kept for comparison: one text line per game,
    split on every comma with no quote handling, fields taken by position.

    A header line stays as a data row and a quoted opening with commas shifts
    the later fields.  Missing positions are NULL; ``id`` is NULL when the
    first field is not a number.
    """
    return spark.read.text(path).select(*line_columns("value"))


def line_columns(line: str) -> list[Column]:
    """The games fields of a line that is split on every comma."""
    parts = F.split(F.col(line), ",")
    cols = [parts.getItem(i).alias(name) for i, name in enumerate(GAMES_COLUMNS)]
    cols[0] = parts.getItem(0).try_cast("long").alias("id")
    return cols


def read_games_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*GAMES_COLUMNS)


def read_ratings_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ratings with no quoting.  Returns
    ``(series, episode, rating, type)``; series is the three id parts joined by
    ``#``, empty parts included; an empty episode name is an empty text, a
    field that the line doesn't have is NULL (in the series: empty); the rating
    is NULL where the text is not a number (a header line)."""
    fields = F.split(F.col("value"), "\t")
    raw = spark.read.text(path).select(
        *[F.get(fields, F.lit(i)).alias(f.name) for i, f in enumerate(RATINGS_SCHEMA.fields)])
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("series_a", "series_b", "series_c")]
    return raw.select(
        F.concat_ws("#", *parts).alias("series"),
        F.col("episode"),
        F.col("rating_text").try_cast("double").alias("rating"),
        F.col("type"),
    )


def measured_games_table(spark: SparkSession, path: str, fmt: str = "csv",
                         moves_mode: str = "dots") -> DataFrame:
    """Games files (``csv``, naive ``lines`` or ``parquet``) measured once and
    written as a Parquet table under ``spark.checkpoint.dir`` (see
    ``gamestats.sources.derived``); later queries read the narrow columns they
    need instead of parsing the text again.  ``path`` is a file or a folder."""
    import sys

    from gamestats.functions import bands, measures
    from gamestats.operators import measured
    from gamestats.operators.measured import measure_games
    from gamestats.sources.derived import definition_fingerprint, derived_table

    readers = {"csv": read_games_csv, "lines": read_games_lines, "parquet": read_games_parquet}
    read = readers[fmt]
    definition = definition_fingerprint(sys.modules[__name__], measures, bands, measured)
    return derived_table(spark, f"games-{fmt}-{moves_mode}", [path],
                         lambda: measure_games(read(spark, path), moves_mode), definition)
