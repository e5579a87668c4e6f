from pyspark.sql import functions as F

from gamestats.llm.common import ascii_lower
from gamestats.llm.exact_dedup import build_directory, exact_dedup, own_chains

ROWS = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 200_000),
        (8, "X" * 200_000), (9, "abd"), (9, "abd"), (None, "abc"), (None, "zz"), (10, "q"), (11, " q")]


def _expected(rows):
    groups = {}
    for i, t in rows:
        norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(norm, []).append(i)
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


def _found(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()], key=str)


def test_cases(documents):
    assert _found(exact_dedup(documents(ROWS))) == _expected(ROWS)


def test_empty_table(documents):
    assert exact_dedup(documents(ROWS).where("false")).count() == 0


def test_colliding_hashes_and_splitting_buckets(documents):
    rows = [(i, f"text {i % 40}") for i in range(120)]
    weak = exact_dedup(documents(rows), key=lambda t: F.length(t).cast("long"),
                       digest=lambda t: F.unhex(F.lit("00")), capacity=2)
    assert _found(weak) == _expected(rows)


def test_owners_chain_without_another_shuffle(spark):
    rows = [(b, k, 1, b"d", t, i, n) for b, k, t, i, n in [
        (0, 5, "x", 1, 2), (0, 5, "x", 9, 1), (0, 5, "y", 4, 3), (0, 6, "x", 2, 2), (1, 7, "z", None, 4)]]
    copies = spark.createDataFrame(rows, "bucket long, key long, n_bytes int, digest binary, norm string, "
                                         "keep_id long, group_size long").repartition(3)
    chains = own_chains(copies)
    got = sorted((r.bucket, r.key, r.chain, r.norm, r.keep_id, r.group_size, r.texts) for r in chains.collect())
    assert got == [(0, 5, 1, "x", 9, 3, 2), (0, 5, 2, "y", 4, 3, 2), (0, 6, 1, "x", 2, 2, 1),
                   (1, 7, 1, "z", None, 4, 1)]
    plan = own_chains(copies)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(bucket" in plan and "hashpartitioning" not in plan


def test_directory_covers_every_key_within_capacity(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    directory, depth = build_directory(keys, capacity=50)
    slots = directory.collect()
    assert sorted(r.slot for r in slots) == list(range(1 << depth))
    filed = (keys.withColumn("slot", F.shiftrightunsigned("key", 64 - depth))
             .join(directory, "slot").groupBy("bucket").count())
    assert filed.agg(F.max("count")).first()[0] <= 50
    assert filed.agg(F.sum("count")).first()[0] == 5000


def test_only_ascii_letters_fold(spark):
    assert spark.range(1).select(ascii_lower(F.lit("AZaz ÀÉİ"))).first()[0] == "azaz ÀÉİ"
