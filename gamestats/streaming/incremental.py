"""The catalogue's keyed statistics over game files as they arrive.

The same measures and keyed aggregations as the batch catalogue, applied to a
Structured Streaming file source.  Spark keeps one partial aggregate (sum,
count) per key in its state store, so state grows with the number of keys
(events, bands, lengths), not with the number of games, and a restarted query
resumes from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gamestats.operators.measured import measure_games
from gamestats.session import ensure_checkpoint_dir
from gamestats.sources.files import GAMES_SCHEMA


def read_games_stream(spark: SparkSession, path: str, fmt: str = "csv",
                      max_files_per_trigger: int | None = None,
                      moves_mode: str = "dots") -> DataFrame:
    """Measured games from files landing in ``path`` (CSV with header, or
    Parquet with the games columns)."""
    reader = spark.readStream.schema(GAMES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        raw = (reader.option("header", True).option("quote", '"').option("escape", '"')
               .csv(path))
    else:
        raw = reader.format(fmt).load(path)
    return measure_games(raw, moves_mode)


def start_keyed_stream(games: DataFrame, query: Callable[[DataFrame], DataFrame],
                       name: str, sink: str = "memory", path: str | None = None,
                       checkpoint: str | None = None, available_now: bool = False,
                       processing_time: str | None = None) -> StreamingQuery:
    """Start one catalogue aggregation (e.g. ``avg_captures_by_event``) on a
    stream of measured games, in complete mode.

    ``sink`` is ``memory`` (a table named ``name``, for tests and notebooks) or
    a file format (``parquet``, ``csv``, ``json``) written to ``path``.  File
    sinks only append, so each trigger's complete result replaces the folder's
    contents through ``foreachBatch``; writing the same complete result again
    after a replayed batch gives the same files.

    The checkpoint goes under the session's ``spark.checkpoint.dir`` (shared
    storage on a cluster) unless given.
    """
    spark = games.sparkSession
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = (query(games).writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint))
    if sink == "memory":
        writer = writer.format("memory").queryName(name)
    else:
        if path is None:
            raise ValueError(f"a {sink} sink needs a path")

        def replace_result(batch: DataFrame, _batch_id: int) -> None:
            out = batch.write.mode("overwrite").format(sink)
            if sink == "csv":
                out = out.option("header", True)
            out.save(path)

        writer = writer.foreachBatch(replace_result).queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
