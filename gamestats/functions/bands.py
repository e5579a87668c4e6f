"""Rating bands (E1-E3): a rating value mapped to a named band.

One band table serves every form.  The forms differ only in which value is
banded and in how it is compared:

* ``band_of_max``      E1, higher of the two ratings, compared as numbers
* ``band_of_max_text`` E1 as the reference runs it: higher of the two rating
  *texts*, compared as text, so ``'950'`` and ``'?'`` land in the top band
* ``band_of_mean``     E2, mean of both ratings
* ``band_of_mean_or_black`` E3, mean of both, or black's rating when white's is
  not a number

Unparsable ratings become NULL (``try_cast``); ``greatest`` skips NULLs, and a
NULL value has a NULL band.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gamestats.functions.measures import _col, to_int

# Band upper edges (exclusive), ascending, and the band names; a
# rating at or above the last edge is in the last band.
BAND_EDGES = (1200, 1400, 1600, 1800, 2000, 2200, 2300, 2400, 2500, 2700)
BAND_NAMES = ("novice", "class D", "class C", "class B", "class A", "CM",
              "CM-NM", "FM-IM", "IM-GM", "GM", "SGM")


def band_of(value: Column | str, as_text: bool = False) -> Column:
    """Band name of a numeric value (or, with ``as_text``, of a string value
    compared lexicographically against the edges written as text)."""
    v = _col(value)
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(BAND_EDGES, BAND_NAMES):
        bound = F.lit(str(edge)) if as_text else F.lit(edge)
        expr = expr.when(v < bound, F.lit(name))
    return expr.otherwise(F.lit(BAND_NAMES[-1]))


def band_of_max(white_elo: Column | str, black_elo: Column | str) -> Column:
    return band_of(F.greatest(to_int(white_elo), to_int(black_elo)))


def band_of_max_text(white_elo: Column | str, black_elo: Column | str) -> Column:
    return band_of(F.greatest(_col(white_elo), _col(black_elo)), as_text=True)


def band_of_mean(white_elo: Column | str, black_elo: Column | str) -> Column:
    return band_of((to_int(white_elo) + to_int(black_elo)) / F.lit(2.0))


def band_of_mean_or_black(white_elo: Column | str, black_elo: Column | str) -> Column:
    w, b = to_int(white_elo), to_int(black_elo)
    return band_of(F.when(w.isNull(), b.cast("double"))
                   .otherwise((w + b) / F.lit(2.0)))


def band_columns(white_elo: Column | str = "white_elo",
                 black_elo: Column | str = "black_elo") -> dict[str, Column]:
    return {
        "elo_band": band_of_max(white_elo, black_elo),
        "elo_band_text": band_of_max_text(white_elo, black_elo),
        "elo_band_mean": band_of_mean(white_elo, black_elo),
        "elo_band_black": band_of_mean_or_black(white_elo, black_elo),
    }
