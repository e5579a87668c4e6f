"""Exact sums against Python's correctly rounded ones."""

import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gamestats.operators.exact import exact_stats

finite = st.floats(allow_nan=False, allow_infinity=False, width=64)
ROWS = st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.one_of(st.none(), finite)),
                min_size=1, max_size=40)


def _fsum(values):
    try:
        return math.fsum(values)
    except OverflowError:
        from fractions import Fraction
        total = sum(map(Fraction, values))
        try:
            return float(total)
        except OverflowError:
            return math.inf if total > 0 else -math.inf


def _got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    return {r["k"]: (r["total"], r["mean"], r["n"]) for r in exact_stats(df, "k", "v").collect()}


def _want(rows):
    out = {}
    for k, v in rows:
        out.setdefault(k, []).append(v)
    for k, vs in out.items():
        vs = [v for v in vs if v is not None]
        total = _fsum(vs) if vs else None
        out[k] = (total, total / len(vs) if vs else None, len(vs))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_equals_the_rounded_sum(spark, rows):
    assert _got(spark, rows) == _want(rows)


HARD = [
    [1e16, 1.0, -1e16], [1e308, 1e308, -1e308], [1e308] * 3, [-1e308] * 3, [5e-324] * 3,
    [0.1] * 10, [2.0 ** 53, 1.0, 1e-30], [2.0 ** 53, 1.0], [-(2.0 ** 53), -1.0, -1e-300], [0.0, -0.0],
    [2.0 ** e for e in range(-1074, 1023, 97)], [2.0 ** 8, 2.0 ** 16, 2.0 ** -8, math.nextafter(2.0 ** 8, 0)],
    [1.7976931348623157e308], [2.2250738585072014e-308, -5e-324], [-3.5, 3.5]]


def test_hard_sums(spark):
    rows = [(str(i), v) for i, values in enumerate(HARD) for v in values]
    assert _got(spark, rows) == _want(rows)


def test_special_values(spark):
    inf, nan = math.inf, math.nan
    rows = [("nan", nan), ("nan", 1.0), ("both", inf), ("both", -inf), ("up", inf), ("up", 2.0),
            ("down", -inf), ("none", None), (None, 1.5), (None, None)]
    got = _got(spark, rows)
    assert math.isnan(got["nan"][0]) and math.isnan(got["both"][0])
    assert got["up"][0] == inf and got["down"][0] == -inf
    assert got["none"] == (None, None, 0) and got[None] == (1.5, 1.5, 1)


def test_any_partitioning_gives_the_same_bits(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}",
             rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 12)) for _ in range(4000)]
    want = _want(rows)
    for parts in (1, 2, 7, 16):
        rng.shuffle(rows)
        assert _got(spark, rows, parts) == want


def test_one_row_per_task_and_bin_is_shuffled(spark):
    df = spark.range(10000).select(F.lit("hot").alias("k"), (F.col("id") * 0.1).alias("v")).repartition(4)
    plan = exact_stats(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan and "Window" not in plan
    assert exact_stats(df.where("v < 0"), "k", "v").count() == 0
