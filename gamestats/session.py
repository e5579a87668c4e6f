"""Session helpers.

The library never starts or stops a session on its own: callers pass one in.
``local_session`` is for tests, benchmarks and examples.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "gamestats") -> SparkSession:
    n_cores = (os.cpu_count() or 8) if cores == "*" else int(cores)
    parts = shuffle_partitions or n_cores
    spark = (SparkSession.builder
             .master(f"local[{cores}]")
             .appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(parts))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """``spark.checkpoint.dir`` is unset on a cluster."""


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    When it is unset, a folder is set only for a local master (tests, local
    runs): ``fallback`` or a fresh temporary one.  On a cluster a
    machine-local folder would scatter files over the executors' disks, so
    ``NoSharedFolder`` is raised instead, unless a ``fallback`` is given.
    """
    sc = spark.sparkContext
    current = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if current:
        return current
    if fallback is None:
        if not sc.master.startswith("local"):
            raise NoSharedFolder(f"set {CHECKPOINT_CONF} to a folder on shared storage")
        fallback = tempfile.mkdtemp(prefix="gamestats-ckpt-")
    # A core setting: it cannot be changed through spark.conf at run time, so
    # the folder is set on the context (which makes a fresh sub-folder in it).
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir()
