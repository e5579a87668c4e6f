"""Derived tables written once and read by many queries.

At archive scale every game query would otherwise redo the same expensive
join (``orders`` x ``lineitem``): one full scan and shuffle of the largest
table per query.  Instead the measured-games view is written once as Parquet
into the shared folder the cluster names in ``spark.checkpoint.dir``, and
every query reads only the columns it needs from it.  Writing the table also
cuts the lineage: a lost executor later costs a re-read, not a re-join.

The table's location carries a fingerprint of its definition (the source of
the code that builds it) and of every input file (path, size, modification
time).  A changed input or a changed definition gives a new
location, so a stale table is never read.  When the table exists, its plan is
not even built: a query pays only a metadata check and the scan of the
columns it reads.
A build writes into a fresh data folder of its own and is published by a small
pointer file that names that folder, written aside and renamed into place, so
a reader never sees a half-written table or pointer, two concurrent builders
never mix files, and no data is renamed or copied.  An error of a build is
raised, never answered by a second run of the plan; only a shared folder that
is missing or can't be written makes a query read the view.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
import warnings
from collections.abc import Callable, Sequence
from types import ModuleType

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.session import NoSharedFolder, ensure_checkpoint_dir

TABLES_FOLDER = "gamestats-tables"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Path, size and modification time of every input file; no data is read.

    A plain file is looked up directly.  A folder or glob is listed by Spark's
    ``binaryFile`` source at any depth, without its content column, and folded
    to a count, a size and an order-free hash over all files, so that only one
    row comes back however many files there are.
    """
    parts = []
    for path in paths:
        p, fs = _hadoop_path(spark, path)
        matches = fs.globStatus(p) or []
        if not matches:
            parts.append(f"{path}|missing")  # the read itself reports the error
        for status in matches:
            found = status.getPath().toString()
            if status.isFile():
                parts.append(f"{found}|{status.getLen()}|{status.getModificationTime()}")
                continue
            files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                     .load(found).select("path", "length", "modificationTime"))
            each = F.xxhash64("path", "length", "modificationTime")
            row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(each),
                            F.sum(each.cast("decimal(20,0)"))).first()
            parts.append("|".join([found, *map(str, row)]))
    return "\n".join(parts)


def definition_fingerprint(*modules: ModuleType) -> str:
    """Digest of the source of the modules that define a table."""
    text = "\n".join(inspect.getsource(m) for m in modules)
    return hashlib.sha256(text.encode()).hexdigest()[:20]


POINTER = "_CURRENT"

# Published tables never change, so a session reuses its reader of a table
# (the file listing and schema are read once) while the table is still there.
_readers: dict[str, tuple[str, DataFrame]] = {}


def _read_pointer(spark: SparkSession, fs, pointer) -> str | None:
    if not fs.exists(pointer):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(pointer)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return line.strip() if line else None


def _create_pointer(fs, pointer, folder: str) -> bool:
    """Publish the pointer naming ``folder``; False if one already exists.  The
    name is written to a file of its own first, and that small file is renamed,
    so that a pointer never shows without its content."""
    if fs.exists(pointer):
        return False
    written = pointer.suffix(f"-{uuid.uuid4().hex}")
    out = fs.create(written, False)
    try:
        out.write(bytearray(folder.encode("utf-8")))
    finally:
        out.close()
    if fs.rename(written, pointer):
        return True
    fs.delete(written, False)        # a concurrent builder was first
    return False


def _published_folder(spark: SparkSession, fs, location: str) -> str | None:
    """The data folder the pointer names, if it is still there.  A pointer is
    only published after a whole build."""
    folder = _read_pointer(spark, fs, _hadoop_path(spark, f"{location}/{POINTER}")[0])
    if folder and fs.exists(_hadoop_path(spark, f"{location}/{folder}")[0]):
        return folder
    return None


def _can_write(fs, folder) -> bool:
    try:
        return bool(fs.mkdirs(folder))
    except Py4JJavaError:
        return False


def derived_table(spark: SparkSession, name: str, inputs: Sequence[str],
                  build: Callable[[], DataFrame], definition: str) -> DataFrame:
    """Read the table ``build()`` defines over ``inputs``, writing it first if
    no table exists yet for this definition and these inputs.

    Each build writes into its own data folder and is published by a small
    pointer file that names it; no data is renamed or copied, which matters on
    object stores, where renaming a folder copies every file.
    """
    try:
        root = ensure_checkpoint_dir(spark).rstrip("/")
    except NoSharedFolder as err:
        warnings.warn(f"derived table {name} not written ({err}); reading the view "
                      "directly", RuntimeWarning, stacklevel=2)
        return build()
    key = f"{name}\n{definition}\n{input_fingerprint(spark, inputs)}"
    digest = hashlib.sha256(key.encode()).hexdigest()[:20]
    location = f"{root}/{TABLES_FOLDER}/{name}-{digest}"
    pointer, fs = _hadoop_path(spark, f"{location}/{POINTER}")
    folder = _published_folder(spark, fs, location)
    cached_folder, cached = _readers.get(location, (None, None))
    if folder and folder == cached_folder and cached.sparkSession is spark:
        return cached
    if folder is None:
        if fs.exists(pointer):
            fs.delete(pointer, False)  # names a folder that is gone or incomplete
        mine = f"data-{uuid.uuid4().hex}"
        target, _ = _hadoop_path(spark, f"{location}/{mine}")
        if not _can_write(fs, pointer.getParent()):
            warnings.warn(f"derived table {name} not written: {root} can't be written; "
                          "reading the view directly", RuntimeWarning, stacklevel=2)
            return build()
        try:
            build().write.mode("error").parquet(f"{location}/{mine}")
        except BaseException:
            fs.delete(target, True)  # drop what the failed write left behind
            raise
        if _create_pointer(fs, pointer, mine):
            folder = mine
        else:  # a concurrent builder published first: use its table, drop ours
            fs.delete(target, True)
            folder = _published_folder(spark, fs, location)
            if folder is None:
                return build()
    reader = spark.read.parquet(f"{location}/{folder}")
    _readers[location] = (folder, reader)
    return reader
