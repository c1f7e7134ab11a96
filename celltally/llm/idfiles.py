"""Token-id files: documents encoded, appended in ascending doc_id order and
compressed block by block, then read back.

A folder ``slab=<n>`` per slab of documents (ascending ranges of doc_id) holds
its blocks in order: ``block``, ``before`` (ids of the slab's earlier blocks),
``n_ids``, ``docs`` and ``lengths`` (doc ids as int64 and ids per document as
uint32, little-endian; a null doc_id is the smallest int64), ``payload`` (the
coded block, see ``idcoder``). Spark writes and commits the folders, so any
shared file system will do and a lost executor's blocks are written again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltally.llm import idcoder, slabs
from celltally.llm import textkit as tk
from celltally.llm.bpe import SLICE_BYTES, file_codec
from celltally.llm.common import ship
from celltally.session import scratch_path

END_ID = 2
NO_ID = np.iinfo(np.int64).min
FILE = "slab int, block int, before long, n_ids long, docs binary, lengths binary, payload binary"


def encoded_slab(table: pa.Table, content: bytes, end_id: int) -> pa.Table:
    codec = file_codec(content)
    n_symbols = max(len(codec.lengths), end_id + 1)
    table, docs = slabs.ordered(table)
    parts, lengths = [], []
    for part in tk.slices(table, limit=SLICE_BYTES):
        ids, at = codec.encode(*tk.text_bytes(part.column("text")))
        parts.append(np.insert(ids, at[1:], end_id))
        lengths.append(np.diff(at) + 1)
    ids, lengths = np.concatenate(parts), np.concatenate(lengths)
    upto = np.concatenate([[0], np.cumsum(lengths)])
    rows, first = [], 0
    while first < len(docs):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + idcoder.BLOCK_IDS, "right")) - 1)
        a, b = upto[first], upto[last]
        rows.append((len(rows), int(a), int(b - a), docs[first:last].astype("<i8").tobytes(), lengths[first:last].astype("<u4").tobytes(),
                     idcoder.encode_block(ids[a:b], n_symbols)))
        first = last
    block, before, n_ids, doc, length, payload = zip(*rows, strict=True)
    return pa.table({"slab": pa.array([table.column("slab")[0].as_py()] * len(rows), pa.int32()), "block": pa.array(block, pa.int32()),
                     "before": pa.array(before, pa.int64()), "n_ids": pa.array(n_ids, pa.int64()), "docs": pa.array(doc, pa.binary()),
                     "lengths": pa.array(length, pa.binary()), "payload": pa.array(payload, pa.binary())})


def write(docs: DataFrame, path: str, content: bytes, end_id: int = END_ID, slab_bytes: int = slabs.SLAB_BYTES) -> str:
    """Encodes ``docs`` with the tokenizer file ``content`` into files at ``path``.

    Null and empty texts are an end id alone; rows of one doc_id follow each
    other by text; a null doc_id comes first; further columns are not written;
    an empty table writes no block.
    """
    base, _ = slabs.deal(docs, slab_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(content)
    rows = base.groupBy("slab").applyInArrow(lambda t: encoded_slab(t, shared.value, end_id), FILE)
    rows.write.partitionBy("slab").parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the files at ``path``.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian
    unsigned 32-bit. One total per slab reaches the driver. A damaged block
    stops the read.
    """
    ship(spark)
    files = spark.read.schema(FILE).parquet(path)
    totals = sorted((r.slab, r.n) for r in files.groupBy("slab").agg(F.sum("n_ids").alias("n")).collect())
    at, offsets = 0, {}
    for slab, n in totals:
        offsets[slab] = at
        at += n
    shared = spark.sparkContext.broadcast(offsets)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = idcoder.decode_block(row["payload"])
                n = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(n)])
                doc = np.frombuffer(row["docs"], "<i8")
                start = shared.value[row["slab"]] + row["before"] + upto[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(doc, mask=doc == NO_ID), pa.array(start), pa.array(n), tk.binary_rows(ids.astype("<u4"), upto)],
                                                 names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def report(docs: DataFrame, content: bytes) -> DataFrame:
    """The digest of the registered query, read back from the files."""
    spark = docs.sparkSession
    out = read(spark, write(docs, scratch_path(spark, "token-ids"), content))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
