"""Spark session helpers.

The library never relies on session settings for correctness: every operator
works on a default session. These settings only tune execution (AQE, skew
splits, Arrow) and give tests a scratch folder when the cluster names none.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Execution settings suggested for large runs. All are public Spark options.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "celltally") -> SparkSession:
    """Local session for tests and benchmarks (UI off, no server port)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CELLTALLY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in TUNING.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """True for a single-process master (``local``, ``local[8]``), whose
    executors share the driver's disk."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster this is the folder named in ``spark.checkpoint.dir``; it is
    read, never replaced, and its absence is an error, since executors could
    not see a folder of the driver. Only a local master (tests) falls back to
    a folder under the system temp directory.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="celltally-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # core setting may be read-only at runtime
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/celltally-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch paths were handed out so far (see ``drop_scratch``)."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def file_system(spark: SparkSession, path: str):
    """The session's file system for ``path`` and the path itself, so any URI
    that Spark reads can be listed."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def drop_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables handed out after ``since``."""
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    for path in paths[since:]:
        fs, jpath = file_system(spark, path)
        fs.delete(jpath, True)
    del paths[since:]
