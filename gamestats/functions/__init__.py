from gamestats.functions.bands import (  # noqa: F401
    BAND_EDGES, BAND_NAMES, band_columns, band_of, band_of_max,
    band_of_max_text, band_of_mean, band_of_mean_or_black)
from gamestats.functions.measures import (  # noqa: F401
    black_win, captures, castled, char_count, checks, draw,
    measure_columns, moves, result_flag, strip, to_double, to_int, white_win)
