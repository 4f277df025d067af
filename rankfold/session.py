"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "rankfold") -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; here we only pin what matters for results
    (UTC session time zone) and what matters for small local runs.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    if master is None and not SparkConf().contains("spark.master"):
        master = f"local[{cpus}]"           # nothing submitted us: a local session
    if master is not None:
        builder = builder.master(master)
        shuffle_partitions = shuffle_partitions or int(cpus)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # scan split size: keep input partitions well inside executor memory at large scale
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("RANKFOLD_MAX_PARTITION_BYTES", "128m"))
        .config("spark.driver.memory", os.environ.get("RANKFOLD_DRIVER_MEMORY", "16g"))
        # checkpoint files of unreachable DataFrames are removed from the shared folder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session first; only in a local session without one (tests)
    do we create one of our own.  Executors could not see a folder of the
    driver's disk, so anywhere else a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="rankfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rankfold-{name}-{uuid.uuid4().hex[:12]}"


_KEPT: list = []


def keep(df):
    """Persist a table that several jobs of one query read; ``release`` frees it."""
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(df)
    return df


def release() -> None:
    """Unpersist what earlier queries kept."""
    while _KEPT:
        _KEPT.pop().unpersist()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rankfold`` importable on the executors' Python workers (like --py-files).

    Grouped-map and co-group functions live in this package; a deployment that
    already installs it on the executors loses nothing by this.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="rankfold-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "rankfold"), "zip", os.path.dirname(pkg_dir), "rankfold")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
