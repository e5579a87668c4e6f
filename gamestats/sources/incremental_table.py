"""A derived table that follows its files one by one (R1).

A manifest lists every input file (path, size, modification time) with the build
that measured it.  When files are added or changed, only those are read: their
rows are written as a build of their own, one partition per file, and a new
manifest version names the builds that are current.  Removed files just leave
the manifest.  Manifests are published as in ``gamestats.sinks``, so a reader
sees the old list or the new one, and a build that died is in neither.

Data that no manifest names any more is removed by ``collect_unused``, unless a
reader holds a version that names it (``holding``).
"""

from __future__ import annotations

import contextlib
import hashlib
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.session import ensure_checkpoint_dir
from gamestats.sources.derived import TABLES_FOLDER, _hadoop_path

MANIFEST = "file string, length long, changed timestamp, key string, build string"
LEASE_SECONDS = 24 * 3600     # a reader that died holds its version no longer


def _plain(path: Column) -> Column:
    """One spelling of a path: sources write a scheme with one or three slashes."""
    return F.regexp_replace(path, "^([a-zA-Z0-9]+):/+", "$1:/")


class IncrementalTable:
    """``read(paths)`` gives the raw rows of files or folders, ``measure(raw)``
    the rows of the table (columns it doesn't know must pass through);
    ``definition`` names what they do, so that a change gives a new table."""

    def __init__(self, spark: SparkSession, name: str, path: str, definition: str,
                 read: Callable[[list[str]], DataFrame], measure: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.read, self.measure = spark, path, read, measure
        digest = hashlib.sha256(f"{name}\n{definition}\n{path}".encode()).hexdigest()[:20]
        self.location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{TABLES_FOLDER}/{name}-{digest}"

    # -- manifests

    def _files(self) -> DataFrame:
        found = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path)
                 .select("path", "length", "modificationTime"))
        file = _plain(F.col("path"))
        return found.select(file.alias("file"), "length", F.col("modificationTime").alias("changed"),
                            F.md5(file).alias("key"))

    def manifest(self, version: str | None = None) -> DataFrame:
        """The files of the current version (or of the one given), with their builds."""
        from gamestats.sinks import versions

        found = versions(self.spark, f"{self.location}/manifest")
        if version is None:
            version = found[-1] if found else None
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(version)

    def refresh(self) -> int:
        """Measure what is new or changed; the number of files measured."""
        from gamestats.sinks import _published
        from gamestats.sources.scratch import written

        files = written(self._files(), "files")
        known = self.manifest()
        same = ["file", "length", "changed", "key"]
        kept = known.join(files, same, "leftsemi")
        fresh = written(files.join(known, same, "leftanti"), "fresh-files")
        n = fresh.count()
        if n == 0 and kept.count() == known.count():
            return 0
        build = uuid.uuid4().hex
        if n:
            # the first time the folder is read as one; later, the new files alone
            first = known.isEmpty()
            paths = [self.path] if first else [r["file"] for r in fresh.select("file").collect()]
            raw = self.read(paths)
            key = F.md5(_plain(F.col("_metadata.file_path")))
            rows = self.measure(raw.select("*", key.alias("_key")))
            rows.write.mode("error").partitionBy("_key").parquet(self._rows(build))
        current = kept.select(*same, "build").union(fresh.select(*same, F.lit(build)))
        _published(self.spark, f"{self.location}/manifest",
                   lambda folder: current.write.mode("error").parquet(folder), 10 ** 9)
        return n

    def _rows(self, build: str = "") -> str:
        return f"{self.location}/rows" + (f"/_build={build}" if build else "")

    def table(self, version: str | None = None) -> DataFrame:
        """The rows of all files of a manifest.  Partitions of files that a later
        build measured again are passed over before they are opened."""
        manifest = self.manifest(version)
        builds = [r["build"] for r in manifest.select("build").distinct().collect()]
        _, fs = _hadoop_path(self.spark, self._rows())
        paths = [self._rows(b) for b in sorted(builds) if fs.exists(_hadoop_path(self.spark, self._rows(b))[0])]
        if not paths:
            return self.measure(self.read([self.path]).select("*", F.lit("").alias("_key"))).drop("_key").limit(0)
        rows = self.spark.read.option("basePath", self._rows()).parquet(*paths)
        current = manifest.select(F.col("build").alias("_build"), F.col("key").alias("_key"))
        return rows.join(current, ["_build", "_key"], "leftsemi").drop("_build", "_key")

    # -- readers and what may be removed

    @contextlib.contextmanager
    def holding(self) -> Iterator[DataFrame]:
        """The current table, kept whole until the block ends."""
        from gamestats.sinks import versions

        version = versions(self.spark, f"{self.location}/manifest")[-1]
        lease, fs = _hadoop_path(self.spark, f"{self.location}/leases/{version.rsplit('-', 1)[1]}-{uuid.uuid4().hex}")
        fs.create(lease, False).close()
        try:
            yield self.table(version)
        finally:
            fs.delete(lease, False)

    def collect_unused(self) -> int:
        """Remove builds that neither the current manifest nor a held one names,
        and the manifests before the current one that nobody holds; the number of
        builds removed.  Not to be run while a refresh is writing."""
        from gamestats.sinks import VERSION, versions

        spark = self.spark
        found = versions(spark, f"{self.location}/manifest")
        leases, fs = _hadoop_path(spark, f"{self.location}/leases")
        held, now = set(), time.time()
        for s in (fs.listStatus(leases) if fs.exists(leases) else []):
            if now - s.getModificationTime() / 1000 < LEASE_SECONDS:
                held.add(s.getPath().getName().split("-")[0])
        live = [v for v in found if v == found[-1] or v.rsplit("-", 1)[1] in held]
        builds = {r["build"] for v in live for r in self.manifest(v).select("build").distinct().collect()}
        rows, _ = _hadoop_path(spark, self._rows())
        gone = [s.getPath() for s in (fs.listStatus(rows) if fs.exists(rows) else [])
                if s.getPath().getName().removeprefix("_build=") not in builds]
        base, _ = _hadoop_path(spark, f"{self.location}/manifest")
        for s in fs.listStatus(base):
            name = s.getPath().getName()
            if name.startswith(VERSION) and not any(v.endswith(name.rsplit("-", 1)[1]) for v in live):
                fs.delete(s.getPath(), False)          # the marker first: nobody finds the version any more
                fs.delete(_hadoop_path(spark, f"{self.location}/manifest/data-{name.rsplit('-', 1)[1]}")[0], True)
        for path in gone:
            fs.delete(path, True)
        return len(gone)


def measured_lines(spark: SparkSession, path: str, moves_mode: str = "dots") -> IncrementalTable:
    """Games in plain comma-separated lines, measured file by file."""
    import sys

    from gamestats.functions import bands, measures
    from gamestats.operators import measured
    from gamestats.sources import files
    from gamestats.sources.derived import definition_fingerprint

    definition = definition_fingerprint(sys.modules[__name__], files, measures, bands, measured)
    return IncrementalTable(
        spark, f"games-by-file-{moves_mode}", path, definition, lambda paths: spark.read.text(paths),
        lambda raw: measured.measure_games(raw.select(*files.line_columns("value"), "_key"), moves_mode))
