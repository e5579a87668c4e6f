"""Chunked merges and the arg-max with ties against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from gamestats.operators.merge import best_items, chunk_index, name_chunks

SCHEMA = "k string, v double, n string"


def _rows(n=3000, seed=2):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", None, "a", "b", "c"]), float(rng.randrange(4)),
             rng.choice(["same", f"n{rng.randrange(500):03d}", f"é{rng.randrange(50)}"])) for _ in range(n)]
    return rows + [("nameless", 1.0, None), ("one", 2.0, "x"), ("a", None, "unrated"), ("b", 9.0, None)]


def _texts(rows):
    out = {}
    for k, _, n in rows:
        if n is not None:
            out.setdefault(k, []).append(n)
    return {k: sorted(v, key=lambda s: s.encode()) for k, v in out.items()}


@pytest.mark.parametrize("size, parts", [(7, 5), (100, 16), (10 ** 6, 3)])
def test_joined_chunks_are_the_text(spark, size, parts):
    rows = _rows()
    chunks = name_chunks(spark.createDataFrame(rows, SCHEMA).repartition(parts), "k", "n", size)
    got = {}
    for r in sorted(chunks.collect(), key=lambda r: (r["k"] or "", r["chunk"])):
        assert r["first_place"] == r["chunk"] * size and r["n_names"] <= size
        assert len(r["names"].split(" | ")) == r["n_names"]
        got.setdefault(r["k"], []).append(r["names"])
    want = _texts(rows)
    assert {k: " | ".join(v) for k, v in got.items()} == {k: " | ".join(v) for k, v in want.items()}
    index = {r["k"]: (r["n_names"], r["n_chunks"], r["n_chars"]) for r in chunk_index(chunks, "k").collect()}
    assert index == {k: (len(v), -(-len(v) // size), len(" | ".join(v))) for k, v in want.items()}


def test_a_hot_series_ends_in_many_tasks(spark):
    n = 30000
    hot = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                F.lpad(F.col("id").cast("string"), 7, "0").alias("n"))
    tied = spark.range(n).select(F.lit("tied").alias("k"), F.lit("again").alias("n"))
    chunks = name_chunks(hot.union(tied), "k", "n", 50).where("k IN ('hot', 'tied')")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = [r["count"] for r in chunks.groupBy("k", F.spark_partition_id().alias("t")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) >= 12 and max(per_task) < 200       # 200 and 600 chunks, 8 tasks
    got = chunks.where("k = 'hot'").orderBy("chunk").collect()
    assert " | ".join(r["names"] for r in got) == " | ".join(f"{i:07d}" for i in range(0, n, 3))


def test_best_items_equal_plain_python(spark):
    rows = _rows()
    got = best_items(spark.createDataFrame(rows, SCHEMA).repartition(6), "k", "v", "n")
    top = {}
    for k, v, _ in rows:
        if v is not None:
            top[k] = max(v, top.get(k, v))
    want = sorted(map(str, ((k, v, n) for k, v, n in rows if v is not None and v == top[k])))
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    merged = name_chunks(got, "k", "n", 10)
    assert {r["k"] for r in merged.collect()} == {k for k, v, n in rows if v is not None and v == top[k] and n}


def test_losers_are_dropped_before_the_shuffle(spark, monkeypatch):
    from gamestats.operators import merge
    plans = []
    monkeypatch.setattr(merge, "written", lambda df, name: plans.append(df) or df)
    df = spark.createDataFrame(_rows(), SCHEMA)
    best_items(df, "k", "v", "n")
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    first, exchange, last = (plan.index("WindowGroupLimit"), plan.index("Exchange hashpartitioning"),
                             plan.rindex("WindowGroupLimit"))
    assert first < exchange < last and plan.count("Scan") == 1      # printed top-down


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert name_chunks(none, "k", "n").count() == 0 and best_items(none, "k", "v", "n").count() == 0
    assert chunk_index(name_chunks(none, "k", "n"), "k").count() == 0
