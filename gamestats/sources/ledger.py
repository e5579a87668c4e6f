"""Files read with a ledger (S2, S3, M8): every line or record is either a row or
a reject with its file, its line and the reason.

Both come from one scan and are kept in one table, so the counts of a file add
up: records = rows + rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.functions.measures import to_double
from gamestats.sources.files import GAMES_COLUMNS, GAMES_SCHEMA, RATINGS_SCHEMA
from gamestats.sources.records import numbered_lines, parsed, quoted_records

# Reasons of a reject.
FIELDS, RATING, NOT_FINITE, RECORD = "fields", "rating", "not finite", "record"
PLACE = ("file", "number", "reason", "text")


def _reason(*tests: tuple[Column, str]) -> Column:
    out = None
    for test, name in tests:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def ratings_with_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ratings as ``(series, episode, rating, type, file, number,
    reason, text)``.  ``reason`` is NULL for a row; otherwise the line is a
    reject and ``text`` holds it whole: too few fields (``fields``), a rating
    that isn't a number (``rating``, as in a header) or is NaN or infinite
    (``not finite``).  A carriage return at the end of a line is left out."""
    lines = numbered_lines(spark, path).withColumn("line", F.regexp_replace("line", "\r$", ""))
    fields = F.split("line", "\t", -1)
    raw = lines.select("file", "number", "line", F.size(fields).alias("_n"),
                       *[F.get(fields, F.lit(i)).alias(f.name) for i, f in enumerate(RATINGS_SCHEMA.fields)])
    rating = to_double("rating_text")
    reason = _reason((F.col("_n") < len(RATINGS_SCHEMA), FIELDS), (rating.isNull(), RATING),
                     (F.isnan(rating) | (F.abs(rating) == float("inf")), NOT_FINITE))
    return raw.select(F.concat_ws("#", "series_a", "series_b", "series_c").alias("series"), "episode",
                      rating.alias("rating"), "type", "file", "number", reason.alias("reason"),
                      F.when(reason.isNotNull(), F.col("line")).alias("text"))


def games_with_ledger(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Quoted games records, line breaks inside quotes included, as the columns of
    ``GAMES_SCHEMA`` and ``(file, number, reason, text)``.  A record with another
    number of fields or an id that isn't a number is a reject (``record``); the
    first record of a file is its header, neither row nor reject."""
    records = quoted_records(spark, path)
    if header:
        records = records.where(F.col("number") > 1)
    rows = parsed(records, GAMES_SCHEMA)
    reason = _reason((F.col("_corrupt").isNotNull(), RECORD))
    return rows.select(*GAMES_COLUMNS, "file", "number", reason.alias("reason"), F.col("_corrupt").alias("text"))


def rows_of(ledger: DataFrame) -> DataFrame:
    """The accepted rows, without the ledger's columns."""
    return ledger.where(F.col("reason").isNull()).drop(*PLACE)


def rejects_of(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("reason").isNotNull()).select(*PLACE)


def ledger_counts(ledger: DataFrame, by: str = "file") -> DataFrame:
    """Per file: records, rows, rejects, and rejects by reason."""
    def some(test: Column) -> Column:
        return F.sum(test.cast("long"))

    reason = F.col("reason")
    return ledger.groupBy(by).agg(
        F.count(F.lit(1)).alias("records"), some(reason.isNull()).alias("rows"),
        some(reason.isNotNull()).alias("rejects"),
        *[some(F.coalesce(reason == r, F.lit(False))).alias(f"rejected_{r.replace(' ', '_')}")
          for r in (FIELDS, RATING, NOT_FINITE, RECORD)])


def ratings_table(spark: SparkSession, path: str) -> DataFrame:
    """The ratings and their ledger written once per input (see
    ``gamestats.sources.derived``): later queries don't parse the text again."""
    import sys

    from gamestats.functions import measures
    from gamestats.sources import files, records
    from gamestats.sources.derived import definition_fingerprint, derived_table

    definition = definition_fingerprint(sys.modules[__name__], files, records, measures)
    return derived_table(spark, "ratings-ledger", [path], lambda: ratings_with_ledger(spark, path), definition)


def measured_ledger_table(spark: SparkSession, path: str, moves_mode: str = "dots") -> DataFrame:
    """Quoted games measured once per input, with their ledger."""
    import sys

    from gamestats.functions import bands, measures
    from gamestats.operators import measured
    from gamestats.sources import files, records
    from gamestats.sources.derived import definition_fingerprint, derived_table

    definition = definition_fingerprint(sys.modules[__name__], files, records, measures, bands, measured)
    return derived_table(spark, f"games-ledger-{moves_mode}", [path],
                         lambda: measured.measure_games(games_with_ledger(spark, path), moves_mode), definition)
