"""Sinks (K1-K6).

``write_parts`` is the scalable default: one file per partition, written in
parallel with Spark's commit protocol, so a lost task is simply retried.  The
single-file forms are for small, already-aggregated results only;
``write_ordered`` writes a total order of any size in sorted parts.

``publish`` replaces a result without a moment in which there is none: every
write is a version of its own in a fresh folder, and it becomes the current one
when an empty marker file named after it appears.  No file is ever renamed or
overwritten, so this holds on object stores and on local disks alike, and a
writer that dies leaves the version before it in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.operators.order import in_ranges, key_order, part_rows, with_positions
from gamestats.sources.derived import _hadoop_path

VERSION = "_version-"


def _writer(df: DataFrame, fmt: str, mode: str):
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    return w


def write_parts(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1: one part file per partition."""
    _writer(df, fmt, mode).save(path)


def write_single(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                 sort_by: str | Column | Sequence[str | Column] | None = None) -> None:
    """K2 / K3: one part file, optionally sorted (names or sort Columns).

    ``repartition(1)`` keeps the aggregation upstream parallel and moves only
    its (small) result into the single writing task; ``coalesce(1)`` would pull
    the whole final aggregation into that task.
    """
    one = df.repartition(1)
    if sort_by is not None:
        keys = [sort_by] if isinstance(sort_by, (str, Column)) else list(sort_by)
        one = one.sortWithinPartitions(*keys)
    _writer(one, fmt, mode).save(path)


def show_rows(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """K4 / K5: print the first ``n`` rows on the driver console."""
    df.show(n, truncate=truncate)


# -- versions (K1, K6) and total orders (K2, K3)

def versions(spark: SparkSession, path: str) -> list[str]:
    """The data folders of a published result, the current one last."""
    base, fs = _hadoop_path(spark, path)
    if not fs.exists(base):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(base))
    return [f"{path.rstrip('/')}/data-{n.rsplit('-', 1)[1]}" for n in names if n.startswith(VERSION)]


def _published(spark: SparkSession, path: str, write: Callable[[str], None], keep: int) -> str:
    base = path.rstrip("/")
    version = uuid.uuid4().hex
    folder = f"{base}/data-{version}"
    target, fs = _hadoop_path(spark, folder)
    try:
        write(folder)
    except BaseException:
        fs.delete(target, True)          # what the failed write left; no marker names it
        raise
    names = sorted(s.getPath().getName() for s in fs.listStatus(target.getParent()))
    markers = [n for n in names if n.startswith(VERSION)]
    number = 1 + (int(markers[-1].split("-")[1]) if markers else 0)
    fs.create(_hadoop_path(spark, f"{base}/{VERSION}{number:012d}-{version}")[0], False).close()
    for old in markers[:max(0, len(markers) - keep)]:
        fs.delete(_hadoop_path(spark, f"{base}/{old}")[0], False)
        fs.delete(_hadoop_path(spark, f"{base}/data-{old.rsplit('-', 1)[1]}")[0], True)
    return folder


def publish(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 1) -> str:
    """K1 / K6, atomic: write ``df`` as the new current version of ``path`` and
    return its folder.  ``keep`` versions before it stay for readers that have
    begun; older ones are removed."""
    return _published(df.sparkSession, path, lambda folder: _writer(df, fmt, "error").save(folder), keep)


def read_published(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """The current version; a missing one raises ``FileNotFoundError``."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).load(found[-1])


MANIFEST = "part int, file string, first_position long, n_rows long, first_key string, last_key string"


def write_ordered(df: DataFrame, path: str, keys: str | Sequence[str], descending: bool = False,
                  parts: int | None = None, keep: int = 1) -> str:
    """K2 / K3 / O1 / R2 for results of any size: sorted Parquet parts whose
    ranges follow each other, with a manifest of the parts in order (rows, first
    position, first and last key as JSON), published as one version.  Read in
    manifest order the rows are those of the sort."""
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)

    def write(folder: str) -> None:
        rows = f"{folder}/rows"
        in_ranges(df, key_order(keys, descending), parts).write.mode("error").parquet(rows)
        table = spark.read.schema(df.schema).parquet(rows)
        key = F.to_json(F.struct(*keys))
        at = F.col("_metadata.row_index")
        bounds = {r["file"]: (r["a"], r["b"]) for r in table.groupBy(
            F.col("_metadata.file_name").alias("file")).agg(
            F.min_by(key, at).alias("a"), F.max_by(key, at).alias("b")).collect()}   # one row a part
        manifest = [(i, f, b, n, *bounds[f]) for i, (f, b, n) in enumerate(part_rows(table))]
        (spark.createDataFrame(manifest, MANIFEST).repartition(1).write.mode("error")
         .parquet(f"{folder}/manifest"))

    return _published(spark, path, write, keep)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.schema(MANIFEST).parquet(f"{found[-1]}/manifest")


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of the current version of an ordered result with their 1-based
    positions, from the manifest and the rows' places in their files: nothing is
    sorted again."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    manifest = spark.read.schema(MANIFEST).parquet(f"{found[-1]}/manifest").collect()   # one row a part
    return with_positions(spark.read.parquet(f"{found[-1]}/rows"),
                          [(r["file"], r["first_position"]) for r in manifest], position)
