"""The star-schema views as text files, for the queries that read files.

Each export is published once per input under ``spark.checkpoint.dir`` and its
folder is then read like any folder of games or ratings files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.session import ensure_checkpoint_dir
from gamestats.sources.derived import input_fingerprint
from gamestats.sources.files import GAMES_COLUMNS
from gamestats.sources.star import games_from_star

FOLDER = "gamestats-exports"
# Every 50th rating is not a number, the one after it lacks fields, and the one
# after that is NaN: the ledger's rejects.
DIRTY_EVERY = 50


def _export(spark: SparkSession, name: str, inputs: list[str], rows: Callable[[], DataFrame], fmt: str,
            options: dict[str, str]) -> str:
    from gamestats.sinks import _published, versions

    digest = hashlib.sha256(f"{name}\n{options}\n{input_fingerprint(spark, inputs)}".encode()).hexdigest()[:20]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{FOLDER}/{name}-{digest}"
    found = versions(spark, path)
    if found:
        return found[-1]
    return _published(spark, path, lambda folder: rows().write.format(fmt).options(**options).save(folder), 1)


_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "emptyValue": ""}


def _games(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame]:
    d = sf_dir.rstrip("/")
    return ([f"{d}/orders.parquet", f"{d}/lineitem.parquet"],
            games_from_star(spark, d, with_text=True).select(*GAMES_COLUMNS))


def quoted_games(spark: SparkSession, sf_dir: str) -> str:
    """Games as quoted CSV with a header; every third game ended in a way that
    takes commas, quotes and a line break to tell."""
    inputs, games = _games(spark, sf_dir)
    told = F.when(F.col("id") % 3 == 0, F.lit('Time forfeit, "flagged"\nafter 1, or 2, moves'))
    return _export(spark, "games-quoted", inputs, lambda: games.withColumn("termination", told.otherwise("Normal")),
                   "csv", _CSV | {"header": "true"})


def plain_games(spark: SparkSession, sf_dir: str) -> str:
    """Games as plain comma-separated lines: no header, no quotes."""
    inputs, games = _games(spark, sf_dir)
    return _export(spark, "games-plain", inputs, lambda: games, "csv", _CSV)


def tab_ratings(spark: SparkSession, sf_dir: str) -> str:
    """The events as tab-separated ratings, some of them dirty.  The series is
    ``user#user % 7#s``."""
    def lines() -> DataFrame:
        events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        dirt = F.col("event_id") % DIRTY_EVERY
        rating = F.when(dirt == 0, "n/a").when(dirt == 2, "NaN").otherwise(F.col("value").cast("string"))
        whole = ["tt", "1", rating, F.col("user_id").cast("string"), (F.col("user_id") % 7).cast("string"), "s",
                 F.col("event_type"), F.col("event_id").cast("string")]
        text = [F.lit(c) if isinstance(c, str) else F.coalesce(c, F.lit("")) for c in whole]
        line = F.when(dirt == 1, F.concat_ws("\t", *text[:5])).otherwise(F.concat_ws("\t", *text))
        return events.select(line.alias("value"))

    return _export(spark, "ratings", [f"{sf_dir.rstrip('/')}/events.parquet"], lines, "text", {})
