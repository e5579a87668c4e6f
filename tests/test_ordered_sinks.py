"""Total orders in parts, positions, and versions that replace each other."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gamestats.operators.order import key_order, ranked
from gamestats.operators.ranking import sort_by_key
from gamestats.sinks import (publish, read_manifest, read_ordered, read_published, versions,
                             write_ordered)

SCHEMA = "k string, v double"


def _rows(n=2000):
    rng = random.Random(4)
    return [(rng.choice(["hot", "hot", None, f"k{rng.randrange(300):03d}"]), rng.randrange(9) / 2) for _ in range(n)]


def _plain(rows, descending):
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: r[1])
    known.sort(key=lambda r: r[0], reverse=descending)
    return known + sorted((r for r in rows if r[0] is None), key=lambda r: r[1])


@pytest.mark.parametrize("descending", [False, True])
def test_positions_are_those_of_the_sort(spark, descending):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = sorted(ranked(df, key_order("k", descending)).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(1, len(rows) + 1))
    assert [(r["k"], r["v"]) for r in got] == _plain(rows, descending)


def test_a_column_called_position_is_replaced(spark):
    df = spark.createDataFrame([("b", 9), ("a", 8)], "k string, position int")
    assert sorted(map(tuple, ranked(df, key_order("k")).collect())) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("descending", [False, True])
def test_manifest_order_is_the_sort(spark, tmp_path, descending):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5)
    write_ordered(df, path, "k", descending, parts=9)
    sorted_keys = [r["k"] for r in sort_by_key(df, "k", descending).collect()]
    back = read_ordered(spark, path)
    assert [r["k"] for r in sorted(back.collect(), key=lambda r: r["position"])] == sorted_keys
    assert back.drop("position").exceptAll(df).count() == 0 and back.count() == df.count()
    manifest = sorted(read_manifest(spark, path).collect())
    assert len(manifest) > 4 and [m["part"] for m in manifest] == list(range(len(manifest)))
    assert max(m["n_rows"] for m in manifest) < 0.5 * df.count()         # "hot" is half of all rows
    at = 0
    for m in manifest:
        assert m["first_position"] == at
        assert json.loads(m["first_key"]).get("k") == sorted_keys[at]
        at += m["n_rows"]
        assert json.loads(m["last_key"]).get("k") == sorted_keys[at - 1]


def test_empty_order(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert ranked(none, key_order("k")).count() == 0
    write_ordered(none, str(tmp_path / "out"), "k")
    assert read_ordered(spark, str(tmp_path / "out")).count() == 0


def test_a_failed_overwrite_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(spark.range(5), path)
    broken = spark.range(1000).repartition(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert sorted(r["id"] for r in read_published(spark, path).collect()) == list(range(5))
    # a writer that dies before its marker leaves a folder that no reader sees
    spark.range(99).write.parquet(f"{path}/data-0123456789abcdef0123456789abcdef")
    assert read_published(spark, path).count() == 5
    assert len(versions(spark, path)) == 1


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "result")
    publish(spark.range(1), path)
    begun = read_published(spark, path)
    publish(spark.range(2), path)
    assert read_published(spark, path).count() == 2 and begun.count() == 1      # begun before, still whole
    publish(spark.range(3), path)
    publish(spark.range(4).withColumn("text", F.lit("a,b")), path, fmt="csv")
    assert len(versions(spark, path)) == 2
    assert read_published(spark, path, "csv", "id long, text string").where("text = 'a,b'").count() == 4
