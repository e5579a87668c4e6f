"""Exact sums of doubles as column expressions.

A double is a 53-bit integer times a power of two.  Split by exponent into bins
of ``WIDTH`` exponents, every value of a bin is a whole multiple of one power of
two that fits a long, so the values of a bin add up without rounding in any
order.  The bins of a group are then joined by carries, as digits in base
``2 ** WIDTH``, and the total is rounded once, to the nearest double.

No function runs in Python: ``bin_of`` and ``units_of`` are used per row,
``total_of`` once per group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 8                 # exponents in a bin
SPARE = 54                # a bin's unit is 2 ** (WIDTH * bin - SPARE)
CARRIES = 14              # bins above the highest that a sum of 10 ** 30 units can reach
UNIT_SUM = "decimal(20,0)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _times_power(x: Column, power: Column) -> Column:
    """``x * 2 ** power``, in two steps: the power alone may leave the range."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def bin_of(x: Column) -> Column:
    """The bin of a double; 0 for zero, NaN and the infinities.  The logarithm
    may round into the next bin at an edge: the spare bits allow for it."""
    return F.when((x != 0) & is_finite(x), F.floor(F.log2(F.abs(x)) / WIDTH)).otherwise(0).cast("int")


def units_of(x: Column) -> Column:
    """How often the unit of its bin a double is: exact, a long; 0 for NaN and
    the infinities."""
    units = _times_power(x, SPARE - WIDTH * bin_of(x))
    return F.when(is_finite(x), units).otherwise(0.0).cast("long")


def total_of(bins: Column) -> Column:
    """The nearest double to the sum of a map from bin to sum of units (up to 30
    digits each).  Null for an empty map."""
    zero = F.lit(0).cast("decimal(38,0)")
    base = 1 << WIDTH
    low = F.array_min(F.map_keys(bins))
    places = F.sequence(low, F.array_max(F.map_keys(bins)) + CARRIES)

    def digits(sign: int) -> Column:
        def step(state: Column, place: Column) -> Column:
            here = F.coalesce(bins[place].cast("decimal(38,0)"), zero) * sign

            def split(t: Column) -> Column:
                digit = F.pmod(t, F.lit(base))
                return F.struct(((t - digit) / base).cast("decimal(38,0)").alias("carry"),
                                F.concat(state["digits"], F.array(digit.cast("int"))).alias("digits"))

            return _let((state["carry"] + here).cast("decimal(38,0)"), split)

        start = F.struct(zero.alias("carry"), F.array().cast("array<int>").alias("digits"))
        return F.aggregate(places, start, step)

    def rounded(sign: Column, d: Column) -> Column:
        top = F.array_max(F.transform(d, lambda x, i: F.when(x > 0, i)))

        def value(top: Column) -> Column:
            # the eight highest digits, and one bit for whether anything follows
            head = F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0).cast("decimal(22,0)"),
                               lambda v, k: (v * base + F.coalesce(F.get(d, top - k), F.lit(0)))
                               .cast("decimal(22,0)"))
            more = F.exists(F.slice(d, F.lit(1), F.greatest(top - 7, F.lit(0))), lambda x: x > 0)
            whole = (head * 2 + F.when(more, 1).otherwise(0)).cast("double")
            return sign * _times_power(whole, WIDTH * (low + top - 7) - SPARE - 1)

        return F.when(top.isNull(), 0.0).otherwise(_let(top, value))

    def signed(plus: Column) -> Column:
        return F.when(plus["carry"] < 0, _let(digits(-1), lambda m: rounded(F.lit(-1.0), m["digits"]))) \
            .otherwise(rounded(F.lit(1.0), plus["digits"]))

    return F.when(F.size(bins) > 0, _let(digits(1), signed))
