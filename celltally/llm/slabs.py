"""Asking all texts about hashes without moving a row per hash.

Documents are dealt into slabs of about ``slab_bytes`` of text each, by ranges
of ``doc_id`` where order matters, else by hash. A slab's task hashes its texts and sends every
shard (a share of the hash space) one sorted array of its distinct keys. A
shard's task sees the arrays of all slabs for its share, and answers each slab
with a small value per key, in the order of the keys. The slab's task then
computes its keys again and reads the answers by position. A key that a third
of all documents hold costs one entry per slab, both ways.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm import textkit as tk
from celltally.llm.common import col, ship

#: Text per slab. Larger slabs make fewer, longer arrays; a task holds one slab.
SLAB_BYTES = 6 << 20


#: Sampled ids per slab that the bounds are taken from.
SAMPLES = 64


def deal(docs: DataFrame, slab_bytes: int = SLAB_BYTES, by_range: bool = True) -> tuple[DataFrame, int]:
    """(doc_id, text, slab) and the number of slabs.

    By range, a slab is a range of ``doc_id``; a null ``doc_id`` is taken as
    smaller than any other. The bounds are approximate quantiles of ids sampled
    in proportion to the bytes of their texts (about ``SAMPLES`` a slab, by a
    hash of the id), so long texts in a row make short ranges; one number per
    slab reaches the driver. Rows of one id, or without id, stay in one slab.
    Otherwise rows are dealt by a hash of id and text; nothing reaches the
    driver but the total of bytes.
    """
    ship(docs.sparkSession)
    base = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").cast("string").alias("text"))
    n_bytes = base.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(n_bytes / slab_bytes))
    if n == 1:
        return base.withColumn("slab", F.lit(0)), 1
    if not by_range:
        return base.withColumn("slab", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")), n
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    draw = F.pmod(F.xxhash64("doc_id", size), F.lit(1 << 20)) / (1 << 20)
    copies = F.floor(size * (SAMPLES / slab_bytes) + draw).cast("int")
    ids = base.select(F.coalesce("doc_id", F.lit(np.iinfo(np.int64).min)).alias("id"), copies.alias("copies")).where("copies > 0")
    ids = ids.select("id", F.explode(F.sequence(F.lit(1), "copies")))
    found = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0] or []
    # a bound is the last id of its slab: an id with many texts ends its range
    bounds = np.unique(np.array(found, np.int64))

    @F.arrow_udf("int")
    def slab_of(doc_id: pa.Array) -> pa.Array:
        at = np.searchsorted(bounds, doc_id.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "left")
        return pa.array(at.astype(np.int32))

    return base.withColumn("slab", slab_of("doc_id")), n


def ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A slab's rows by doc_id, then text, nulls first; and the ids, a null
    being the smallest number."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
    return table, table.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()


def narrow(h: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard and 32 bits of a hash in one number, ordered by shard.

    Two hashes fall together only if both agree; with shards in proportion to
    the data this stays rare at any size.
    """
    return (h % tk.U(n_shards)) << tk.U(32) | h >> tk.U(32)


def shard_cuts(shards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shards present in a sorted array, and where each begins and ends."""
    present, begin = np.unique(shards, return_index=True)
    return present, np.append(begin, len(shards))


def rows_of(slab: int, level: int, present, cuts, *columns: np.ndarray) -> pa.Table:
    """One row per shard: (slab, shard, level, keys), keys being the slices of the columns one after another."""
    blobs = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    n = len(blobs)
    return pa.table({"slab": pa.array([slab] * n, pa.int32()), "shard": pa.array(present.astype(np.int32), pa.int32()),
                     "level": pa.array([level] * n, pa.int32()), "keys": pa.array(blobs, pa.binary())})


ROWS = "slab int, shard int, level int, keys binary"


def collected(table: pa.Table) -> list[tuple[int, bytes]]:
    """(slab, keys) of a shard's rows by slab."""
    return sorted(zip(table.column("slab").to_pylist(), table.column("keys").to_pylist(), strict=True))


def answers_of(slab_rows: list, table: pa.Table, level: int, answers: list[bytes]) -> pa.Table:
    n = len(slab_rows)
    shard = table.column("shard")[0].as_py()
    return pa.table({"slab": pa.array([s for s, _ in slab_rows], pa.int32()), "shard": pa.array([shard] * n, pa.int32()),
                     "level": pa.array([level] * n, pa.int32()), "keys": pa.array(answers, pa.binary())})


def told(table: pa.Table, level: int) -> list[bytes]:
    """The answers of one level to a slab, by shard."""
    rows = [(s, k) for s, lv, k in zip(table.column("shard").to_pylist(), table.column("level").to_pylist(),
                                       table.column("keys").to_pylist(), strict=True) if lv == level]
    return [k for _, k in sorted(rows)]


def bits(table: pa.Table, level: int, cuts: np.ndarray) -> np.ndarray:
    """One bool per key from packed answers."""
    parts = [np.unpackbits(np.frombuffer(k, np.uint8), count=int(n)) for k, n in zip(told(table, level), np.diff(cuts), strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
