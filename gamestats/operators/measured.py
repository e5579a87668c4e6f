"""The measured-games frame: games plus every per-game measure and band.

All catalogue queries read this frame.  Columns are added as expressions only;
Catalyst prunes whatever a query does not use, so building "all" measures costs
nothing for a query that needs two of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gamestats.functions.bands import band_columns
from gamestats.functions.measures import measure_columns, strip


def finish_games(df: DataFrame) -> DataFrame:
    """Strip the text keys (event, opening) and add the four rating bands."""
    return df.withColumns({"event": strip("event"), "opening": strip("opening"),
                           **band_columns("white_elo", "black_elo")})


def measure_games(games: DataFrame, moves_mode: str = "dots") -> DataFrame:
    """Games with a move text column ``an`` -> measured games (``an`` dropped)."""
    measured = games.withColumns(measure_columns("an", "result", moves_mode))
    return finish_games(measured).drop("an")
