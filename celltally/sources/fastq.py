"""FASTQ sources (Python Data Source API).

Paired files are read *together* in one task and zipped record by record, which
makes the positional pairing free of any shuffle. Files above ``SPLIT_BYTES``
that can be entered in several places (gzip of many members, plain text, see
``sources.members``) are read by many tasks: each takes a range of record
numbers, enters every file at the last member that begins before the first of
them, and leaves the lines before it out. A gzip file of one member is one
task's work. Folders are listed through the session's file system; executors
open a file by its URI or path.

Each line is cut to its first whitespace-separated token; the plus line
keeps only its first character. Lines are split and cut in bulk.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from celltally.session import file_system
from celltally.sources import members

BATCH = 65536
#: Compressed bytes of a file that one task reads, if the file can be entered in several places.
SPLIT_BYTES = 64 << 20
#: Bytes that a task searches for members, at least.
SEARCH_BYTES = 1 << 20
SINGLE_SCHEMA = "sample string, file string, rec_no long, name string, seq string, plus string, qual string"
PAIR_SCHEMA = (
    "sample string, chunk string, rec_no long, r1_name string, r1_seq string, r1_plus string, r1_qual string, "
    "r2_name string, r2_seq string, r2_plus string, r2_qual string"
)


def fields(lines) -> list:
    """Name, sequence, first character of the plus line and quality of each whole record among the lines."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n, out = len(lines) // 4, []
    for i in range(4):
        column = lines.take(pa.array(np.arange(n) * 4 + i)).cast(pa.large_string())
        words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(column), max_splits=1)
        out.append(pc.list_element(words, 0).cast(pa.string()))
    out[2] = pc.utf8_slice_codeunits(out[2], 0, 1)
    return out


def records(task: dict):
    """Record batches of a task: ``n`` records (None: all) of its ``files``,
    each entered at its place of ``start``, ``partial`` and ``skip`` lines."""
    import pyarrow as pa

    paired = len(task["files"]) == 2
    names = ["name", "seq", "plus", "qual"]
    names = ["sample", "chunk" if paired else "file", "rec_no", *([f"r1_{c}" for c in names] + [f"r2_{c}" for c in names] if paired else names)]
    none = [None] * len(task["files"])
    sides = [members.Lines(p, start or 0, bool(partial), skip or 0) for p, start, partial, skip in
             zip(task["files"], task.get("start") or none, task.get("partial") or none, task.get("skip") or none, strict=True)]
    rec, left = task["base"], task.get("n")
    try:
        while left is None or left > 0:
            want = BATCH if left is None else min(BATCH, left)
            found = [fields(s.take(4 * want)) for s in sides]
            sizes = [len(f[0]) for f in found]
            if min(sizes) < max(sizes) and not task["last"]:
                raise ValueError(f"sample {task['sample']}: {task['files']} differ in length before the last chunk")
            n = max(sizes) if task["tail"] else min(sizes)
            if n:
                columns = [pa.concat_arrays([c[:n], pa.nulls(max(n - len(c), 0), pa.string())]) for f in found for c in f]
                yield pa.RecordBatch.from_arrays([pa.array([task["sample"]] * n, pa.string()), pa.array([task["tag"]] * n, pa.string()),
                                                  pa.array(range(rec, rec + n), pa.int64()), *columns], names=names)
            if n < want:
                break
            rec, left = rec + n, None if left is None else left - n
    finally:
        for s in sides:
            s.close()


class _Part(InputPartition):
    def __init__(self, task: dict):
        super().__init__(None)
        self.task = task


class _FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.items = json.loads(options["items"])

    def partitions(self):
        return [_Part(it) for it in self.items]

    def read(self, partition: _Part | None):
        if partition is not None:  # without tasks Spark asks for one partition of nothing
            yield from records(partition.task)


class FastqSource(DataSource):
    """``spark.read.format("celltally_fastq").option("items", json)``:
    items = tasks of ``records`` with one file each - one partition per task."""

    @classmethod
    def name(cls):
        return "celltally_fastq"

    def schema(self):
        return SINGLE_SCHEMA

    def reader(self, schema):
        return _FastqReader(self.options)


class FastqPairSource(DataSource):
    """``spark.read.format("celltally_fastq_pairs").option("items", json)``:
    items = tasks of ``records`` with two files each."""

    @classmethod
    def name(cls):
        return "celltally_fastq_pairs"

    def schema(self):
        return PAIR_SCHEMA

    def reader(self, schema):
        return _FastqReader(self.options)


def register(spark: SparkSession) -> None:
    """Register both sources. The modules are pickled by value, so Python
    workers need no installed copy of the package."""
    import sys

    members.pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FastqSource)
    spark.dataSource.register(FastqPairSource)


def split_tasks(spark: SparkSession, items: list[dict], split_bytes: int) -> tuple[DataFrame | None, list[dict]]:
    """Tasks (a row each) of the items whose files can all be entered in
    several places, and the items that stay one task.

    The file of an item with more records sets the ranges: a task begins at the
    first record that begins in each ``split_bytes`` of it. The place in the
    other file is that of its last member before that record.
    """
    sizes = members.file_sizes(spark, sorted({p for it in items for p in it["files"]}))
    big = [it for it in items if max(sizes[p] for p in it["files"]) > split_bytes]
    if not big:
        return None, items
    found, n_lines = members.index(spark, {p: sizes[p] for it in big for p in it["files"]}, max(split_bytes, SEARCH_BYTES))
    split = [it for it in big if all(p in n_lines for p in it["files"])]
    if not split:
        return None, items
    heads = []
    for i, it in enumerate(split):
        n = [n_lines[p] // 4 for p in it["files"]]
        if min(n) < max(n) and not it["last"]:
            raise ValueError(f"sample {it['sample']}: {it['files']} differ in length before the last chunk")
        heads.append((i, it["sample"], it["tag"], it["files"], it["base"], it["last"], it["tail"], max(n) if it["tail"] else min(n), n.index(max(n))))
    heads = spark.createDataFrame(heads, "item int, sample string, tag string, files array<string>, base long, last boolean, tail boolean, total long, lead int")
    places = heads.select("item", "total", "lead", F.posexplode("files").alias("side", "path")).join(found, "path")
    chunk = F.floor(F.col("start") / F.lit(split_bytes))
    cuts = places.where("side = lead").groupBy("item", "total", chunk.alias("chunk")).agg(F.min("at_line").alias("at_line"))
    cuts = cuts.select("item", F.ceil(F.col("at_line") / 4).alias("first"), "total").where("first < total").distinct()
    then = F.lead("first").over(Window.partitionBy("item").orderBy("first"))
    cuts = cuts.select("item", "first", (F.coalesce(then, "total") - F.col("first")).alias("n"))
    # the last place of each side at or before a cut, in the order of lines
    sides = heads.select("item", F.explode(F.sequence(F.lit(0), F.size("files") - 1)).alias("side"))
    asked = cuts.join(sides, "item").select("item", "side", (F.col("first") * 4).alias("line"), F.lit(1).alias("kind"), "first", "n", F.lit(None).alias("place"))
    place = F.struct("start", "partial", "at_line")
    known = places.select("item", "side", F.col("at_line").alias("line"), F.lit(0).alias("kind"), F.lit(None).alias("first"), F.lit(None).alias("n"), place.alias("place"))
    upto = Window.partitionBy("item", "side").orderBy("line", "kind", "place.start").rowsBetween(Window.unboundedPreceding, 0)
    met = known.unionByName(asked).select("*", F.last("place", ignorenulls=True).over(upto).alias("at")).where("kind = 1")
    side = F.struct("side", F.col("at.start").alias("start"), F.col("at.partial").alias("partial"), (F.col("line") - F.col("at.at_line")).alias("skip"))
    tasks = met.groupBy("item", "first", "n").agg(F.array_sort(F.collect_list(side)).alias("at"))
    tasks = heads.join(tasks, "item").select("sample", "tag", "files", "at.start", "at.partial", "at.skip", (F.col("base") + F.col("first")).alias("base"),
                                             "n", "last", "tail", F.row_number().over(Window.orderBy("item", "first")).alias("task"))
    return tasks, [it for it in items if it not in split]


def _records_of_rows(batches):
    for batch in batches:
        for task in batch.to_pylist():
            yield from records(task)


def read_items(spark: SparkSession, items: list[dict], split_bytes: int, source: str, schema: str) -> DataFrame:
    register(spark)
    tasks, rest = split_tasks(spark, items, split_bytes)
    out = None
    if tasks is not None:
        tasks = members.land(tasks, "fastq-tasks")
        n = max(tasks.count(), 1)
        out = tasks.repartitionById(n, (F.col("task") - 1).cast("int")).mapInArrow(_records_of_rows, schema)
    if rest or out is None:
        whole = spark.read.format(source).option("items", json.dumps(rest)).load()
        out = whole if out is None else out.unionByName(whole)
    return out


def read_fastq(spark: SparkSession, paths: list[str], sample: str = "", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Single FASTQ files -> (sample, file, rec_no, name, seq, plus, qual);
    rec_no counts records from 0 in each file."""
    items = [{"sample": sample, "tag": p, "files": [p], "base": 0, "last": True, "tail": False} for p in paths]
    return read_items(spark, items, split_bytes, "celltally_fastq", SINGLE_SCHEMA)


def read_fastq_pairs(spark: SparkSession, pairs: list[dict], tail: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Paired files -> one row per record pair, up to the shorter file's end.

    ``pairs``: dicts with sample, r1, r2 and optional chunk, base (the rec_no
    of the chunk's first record) and last (false: both files must end
    together). With ``tail`` the longer file's other records follow, the
    columns of the missing side being null."""
    items = [
        {"sample": p["sample"], "tag": str(p.get("chunk", "")), "files": [p["r1"], p["r2"]], "base": int(p.get("base", 0)),
         "last": bool(p.get("last", True)), "tail": tail}
        for p in pairs
    ]
    return read_items(spark, items, split_bytes, "celltally_fastq_pairs", PAIR_SCHEMA)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = file_system(spark, path)
    return fs.exists(jpath)


def listed(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, as URIs; nothing if there is no such folder."""
    fs, jpath = file_system(spark, path)
    return sorted(str(f.getPath().toString()) for f in fs.listStatus(jpath)) if fs.exists(jpath) else []


def sample_pairs(spark: SparkSession, raw_fq_dir: str, sample: str) -> list[dict]:
    """File pairs of a sample in a directory (path or URI):
    ``<sample>_R1.fq.gz`` with ``<sample>_R2.fq.gz``, or the chunked layout
    ``<sample>_R1/chunk=<first rec_no>/*.gz`` of ``write_fastq_chunks``."""
    d = raw_fq_dir.rstrip("/")
    plain = (f"{d}/{sample}_R1.fq.gz", f"{d}/{sample}_R2.fq.gz")
    there = [_exists(spark, p) for p in plain]
    if all(there):
        return [{"sample": sample, "chunk": "", "r1": plain[0], "r2": plain[1], "base": 0}]
    if any(there):
        raise FileNotFoundError(f"sample {sample}: {plain[there.index(False)]} is missing")
    pairs = chunk_pairs(spark, f"{d}/{sample}_R1", f"{d}/{sample}_R2", sample)
    if not pairs:
        raise FileNotFoundError(f"sample {sample}: no FASTQ files in {d}")
    return pairs


def chunk_pairs(spark: SparkSession, r1_dir: str, r2_dir: str, sample: str) -> list[dict]:
    """Match the ``chunk=<first rec_no>`` folders of two read folders (one file
    each). One side may end earlier; a chunk missing before that is an error."""
    def chunks(d):
        out = {}
        for sub in listed(spark, d):
            m = re.search(r"chunk=(\d+)$", sub)
            files = [f for f in listed(spark, sub) if re.search(r"/part-[^/]*$", f)] if m else []
            if files:
                if len(files) != 1:
                    raise ValueError(f"expected one file in {sub}, found {len(files)}")
                out[int(m.group(1))] = files[0]
        return out

    a, b = chunks(r1_dir), chunks(r2_dir)
    n = min(len(a), len(b))
    if sorted(a)[:n] != sorted(b)[:n]:
        gone = sorted(set(sorted(a)[:n]) ^ set(sorted(b)[:n]))[0]
        raise FileNotFoundError(f"sample {sample}: chunk {gone} is missing in {r1_dir if gone not in a else r2_dir}")
    keys = sorted(a)[:n]
    return [{"sample": sample, "chunk": str(k), "r1": a[k], "r2": b[k], "base": k, "last": k == keys[-1]} for k in keys]
