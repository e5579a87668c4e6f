"""Per-game measures as ``Column -> Column`` expressions.

Every measure is a built-in Catalyst expression (no Python UDF), so it runs
inside whole-stage codegen next to the scan.  All of them count characters or
test containment in the move text; a missing move text counts as ``''``.

Because they only count characters and look for short patterns with no space
in them, the counting measures are *additive over space-joined fragments*:
``captures(a || ' ' || b) == captures(a) + captures(b)`` and
``has_double_plus(a || ' ' || b) == has_double_plus(a) OR has_double_plus(b)``.
The star-schema adapter relies on that to aggregate per line item instead of
building each game's text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result strings, the characters counted in the move text, and the
# set of characters stripped from keys (Python's str.strip() ASCII whitespace).
WHITE_WINS = "1-0"
BLACK_WINS = "0-1"
DRAWN = "1/2-1/2"
MOVE_MARK = "."
CAPTURE_MARK = "x"
CHECK_MARK = "+"
MATE_MARK = "++"
CASTLE_NOTATION = "O-O"
CASTLE_DASH = "-"
WHITESPACE = " \t\n\r\x0b\x0c"
# Numbered-move form: a move number followed by a dot and a space (so "1..." is
# not counted), after dropping {...} annotations.
NUMBERED_MOVE = r"\d+\. "
ANNOTATION = r"\{[^}]*\}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(an: Column | str) -> Column:
    return F.coalesce(_col(an), F.lit(""))


def char_count(text: Column | str, needle: str) -> Column:
    """Occurrences of a literal substring (not a regex), as LONG."""
    t = _text(text)
    n = F.length(t) - F.length(F.replace(t, F.lit(needle), F.lit("")))
    if len(needle) > 1:
        n = n / F.lit(len(needle))
    return n.cast("long")


def contains_flag(text: Column | str, needle: str) -> Column:
    """1 if the literal substring occurs, else 0 (INT)."""
    return F.contains(_text(text), F.lit(needle)).cast("int")


def moves(an: Column | str, mode: str = "dots") -> Column:
    """M1 / M1b: move count.

    ``dots`` (as the reference counts it): number of ``.`` characters.
    ``numbered``: number of ``<digits>. `` after dropping ``{...}`` annotations,
    so ``12...`` continuations and dots inside annotations are not counted.
    """
    if mode == "dots":
        return char_count(an, MOVE_MARK)
    if mode == "numbered":
        stripped = F.regexp_replace(_text(an), ANNOTATION, "")
        return F.regexp_count(stripped, F.lit(NUMBERED_MOVE)).cast("long")
    raise ValueError(f"unknown moves mode {mode!r}")


def captures(an: Column | str) -> Column:
    """M2: number of ``x`` in the move text."""
    return char_count(an, CAPTURE_MARK)


def has_double_plus(an: Column | str) -> Column:
    return contains_flag(an, MATE_MARK)


def checks(an: Column | str) -> Column:
    """M3: number of ``+``, minus one if ``++`` occurs at all (only one is
    subtracted however many ``++`` there are, as in the reference)."""
    return char_count(an, CHECK_MARK) - has_double_plus(an)


def castled(an: Column | str, mode: str = "notation") -> Column:
    """M4: castling flag.

    ``notation``: the text contains ``O-O`` (also matches ``O-O-O``).
    ``dash`` (as the reference tests it): the text contains any ``-``.
    """
    if mode == "notation":
        return contains_flag(an, CASTLE_NOTATION)
    if mode == "dash":
        return contains_flag(an, CASTLE_DASH)
    raise ValueError(f"unknown castling mode {mode!r}")


def result_flag(result: Column | str, value: str) -> Column:
    """0/1 flag for one result string; a missing result is 0."""
    return F.coalesce(_col(result) == F.lit(value), F.lit(False)).cast("int")


def draw(result: Column | str) -> Column:
    """M5."""
    return result_flag(result, DRAWN)


def white_win(result: Column | str) -> Column:
    """M6."""
    return result_flag(result, WHITE_WINS)


def black_win(result: Column | str) -> Column:
    return result_flag(result, BLACK_WINS)


def strip(c: Column | str) -> Column:
    """M7: strip surrounding ASCII whitespace (``F.trim`` strips spaces only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def to_double(c: Column | str) -> Column:
    """M8: numeric cast that yields NULL, not an error, on dirty text."""
    return _col(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def measure_columns(an: Column | str = "an", result: Column | str = "result",
                    moves_mode: str = "dots") -> dict[str, Column]:
    """All per-game measures, keyed by output column name."""
    return {
        "moves": moves(an, moves_mode),
        "captures": captures(an),
        "checks": checks(an),
        "castled": castled(an, "notation"),
        "castled_dash": castled(an, "dash"),
        "draw": draw(result),
        "white_win": white_win(result),
        "black_win": black_win(result),
    }
