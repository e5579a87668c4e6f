"""Property tests: the Spark measures against plain-Python definitions on
generated move texts, and the additivity the star view relies on."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gamestats.functions import measures as M

ALPHABET = "x+.-O 0123456789abeNQ{}[]%"
texts = st.text(alphabet=ALPHABET, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_measures(s):
    return (s.count("."),
            len(re.findall(r"\d+\. ", re.sub(r"\{[^}]*\}", "", s))),
            s.count("x"),
            s.count("+") - (1 if "++" in s else 0),
            int("O-O" in s),
            int("-" in s))


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=30))
def test_measures_match_python_definitions(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, an string")
    got = df.orderBy("i").select(
        M.moves("an"), M.moves("an", "numbered"), M.captures("an"), M.checks("an"),
        M.castled("an"), M.castled("an", "dash")).collect()
    assert [tuple(r) for r in got] == [py_measures(t) for t in batch]


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=12))
def test_counts_are_additive_over_space_joined_fragments(spark, frags):
    df = spark.createDataFrame([(f,) for f in frags], "f string")
    parts = df.agg(F.sum(M.moves("f")), F.sum(M.captures("f")),
                   F.sum(M.char_count("f", "+")), F.max(M.has_double_plus("f")),
                   F.max(M.castled("f")), F.max(M.castled("f", "dash"))).first()
    joined = " ".join(frags)
    whole = (joined.count("."), joined.count("x"), joined.count("+"),
             int("++" in joined), int("O-O" in joined), int("-" in joined))
    assert tuple(parts) == whole


def py_band(value, as_text=False):
    """Independent band rule: position of the value among the edges."""
    import bisect

    from gamestats.functions.bands import BAND_EDGES, BAND_NAMES

    if value is None:
        return None
    edges = [str(e) for e in BAND_EDGES] if as_text else list(BAND_EDGES)
    return BAND_NAMES[bisect.bisect_right(edges, value)]


def _int(text):
    return int(text) if text is not None and text.isdigit() else None


ratings = st.one_of(st.none(), st.just("?"), st.integers(0, 3200).map(str))


@SETTINGS
@given(st.lists(st.tuples(ratings, ratings), min_size=1, max_size=40))
def test_bands_match_an_independent_rule(spark, pairs):
    from gamestats.functions import bands as B

    df = spark.createDataFrame([(i, w, b) for i, (w, b) in enumerate(pairs)],
                               "i int, w string, b string")
    got = [tuple(r) for r in df.orderBy("i").select(
        B.band_of_max("w", "b"), B.band_of_max_text("w", "b"),
        B.band_of_mean("w", "b"), B.band_of_mean_or_black("w", "b")).collect()]
    want = []
    for w, b in pairs:
        wi, bi = _int(w), _int(b)
        nums = [v for v in (wi, bi) if v is not None]
        texts = [v for v in (w, b) if v is not None]
        mean = (wi + bi) / 2 if wi is not None and bi is not None else None
        fallback = bi if wi is None else mean
        want.append((py_band(max(nums) if nums else None),
                     py_band(max(texts) if texts else None, as_text=True),
                     py_band(mean), py_band(fallback)))
    assert got == want


rows_st = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abcd")),
                             st.integers(0, 3).map(float),
                             st.text(alphabet="xyz", min_size=1, max_size=3)),
                   min_size=1, max_size=40)


@SETTINGS
@given(rows_st)
def test_keyed_operators_match_python(spark, rows):
    from gamestats.operators.keyed import keyed_mean, keyed_pct, keyed_ratio
    from gamestats.operators.ranking import top_k

    df = spark.createDataFrame(rows, "k string, v double, n string").withColumn(
        "flag", (F.col("v") >= 2).cast("int"))
    groups = {}
    for k, v, _ in rows:
        groups.setdefault(k, []).append(v)
    mean = {k: sum(vs) / len(vs) for k, vs in groups.items()}
    pct = {k: sum(1 for v in vs if v >= 2) / len(vs) * 100 for k, vs in groups.items()}

    got_mean = {r["k"]: r["m"] for r in keyed_mean(df, "k", "v", "m").collect()}
    got_pct = {r["k"]: r["p"] for r in keyed_pct(df, "k", "flag", "p").collect()}
    assert got_mean == mean and got_pct == pct
    ratio = keyed_ratio(df, "k", "flag", "p")
    assert {r["k"]: r["p"] for r in ratio.collect()} == pct

    ranked = sorted(mean.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[:2]
    got_top = [(r["k"], r["m"]) for r in top_k(keyed_mean(df, "k", "v", "m"), "m", 2, "k")
               .collect()]
    assert got_top == ranked


@SETTINGS
@given(rows_st)
def test_best_and_all_names_match_python(spark, rows):
    from gamestats.operators.best import all_names, best_names

    df = spark.createDataFrame(rows, "k string, v double, n string")
    groups = {}
    for k, v, n in rows:
        groups.setdefault(k, []).append((v, n))
    want_best, want_all = {}, {}
    for k, items in groups.items():
        top = max(v for v, _ in items)
        avg = math.fsum(v for v, _ in items) / len(items)
        want_best[k] = (" | ".join(sorted(n for v, n in items if v == top)), top, avg)
        want_all[k] = (" | ".join(sorted(n for _, n in items)), top, avg)
    got_best = {r["k"]: (r["best_names"], r["max_rating"], r["avg_rating"])
                for r in best_names(df, "k", "v", "n").collect()}
    got_all = {r["k"]: (r["names"], r["max_rating"], r["avg_rating"])
               for r in all_names(df, "k", "v", "n").collect()}
    assert got_best == want_best and got_all == want_all
