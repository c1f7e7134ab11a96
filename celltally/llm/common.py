"""Plan helpers of the text operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltally.session import scratch_path

#: A word is a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: A lookup table up to this many bytes may be broadcast; its size is measured.
BROADCAST_BYTES = 8 << 20


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch of texts.
BATCH_ROWS = 2000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors: Spark hands out a zip of
    its sources once per application. Whole texts are long rows, so Arrow
    batches get ``BATCH_ROWS`` unless the session says otherwise."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # the default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="celltally-src-"), "celltally_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what follows survives lost executors, reads the rows
    twice without computing them twice, and the planner knows their size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a landed table) marked for broadcast if its measured size allows."""
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df


def named(df: DataFrame, name: str) -> str:
    """The column that ``name`` means, as ``df`` spells it."""
    return next(c for c in df.columns if c.lower() == name.lower())


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name
