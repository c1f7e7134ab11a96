"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.session import scratch_path

# Largest size in bytes a lookup side may have to be broadcast. Sides above it
# are joined by a shuffle on their keys instead.
DEFAULT_BROADCAST_BYTES = 64 << 20


def table_bytes(df: DataFrame) -> int:
    """Size of the rows: string bytes as they are, eight for other columns."""
    width = [F.coalesce(F.octet_length(c), F.lit(0)) + 8 if t == "string" else F.lit(8) for c, t in df.dtypes]
    return df.agg(F.sum(sum(width[1:], width[0]))).first()[0] or 0


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: what follows
    neither repeats its work nor hangs on the executors that did it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                       materialize: bool = False) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring it.

    The measure is one small job over a reference-sized table (annotation,
    barcode dictionary, contig list). With ``materialize`` the table is first
    written to the session's shared folder, so the measure and the join read
    it once. ``max_bytes=None`` or ``0`` leaves the choice to the planner.
    """
    if not max_bytes:
        return df
    if materialize:
        df = land(df, "lookup")
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df


def bins(start, end, bin_size: int):
    """Array of the bin numbers a half-open interval [start, end) touches."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    first = F.floor(s / F.lit(bin_size)).cast("long")
    last = F.floor((F.greatest(e, s + 1) - 1) / F.lit(bin_size)).cast("long")
    return F.sequence(first, last)


def first_bin(start, bin_size: int):
    s = F.col(start) if isinstance(start, str) else start
    return F.floor(s / F.lit(bin_size)).cast("long")
