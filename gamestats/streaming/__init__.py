from gamestats.streaming.incremental import read_games_stream, start_keyed_stream  # noqa: F401
