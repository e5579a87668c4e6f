from gamestats.sources.files import (  # noqa: F401
    GAMES_COLUMNS, GAMES_SCHEMA, RATINGS_SCHEMA, measured_games_table, read_games_csv,
    read_games_lines, read_games_parquet, read_ratings_tsv)
from gamestats.sources.derived import derived_table  # noqa: F401
from gamestats.sources.star import games_from_star, games_table, ratings_from_events  # noqa: F401
