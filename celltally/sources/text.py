"""Delimited-text sources: manifest, whitelist, GTF, SAM, feature and
overlap tables. Spark's own readers do the work; a leading UTF-8 byte order
mark is dropped by Spark's csv and text readers."""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.session import file_system
from celltally.sources import members

MANIFEST_COLUMNS = ("sample", "raw_fq_dir", "cbc_file")
GTF_COLUMNS = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attribute"]
FEATURE_SCHEMA = "chr string, start long, end long, strand string, gene_fullname string"
OVERLAP_SCHEMA = "chrom string, start long, end long, qname string, strand string, gene_fullname string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest CSV with a header row: one line per sample. The three columns
    may stand in any order among others; without one of them the manifest is
    refused."""
    table = spark.read.csv(path, header=True)
    absent = [c for c in MANIFEST_COLUMNS if c not in table.columns]
    if absent:
        raise ValueError(f"manifest {path} lacks {' and '.join(absent)}; it has {table.columns}")
    return table.select(*MANIFEST_COLUMNS)


def read_whitelist(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """Headerless TSV ``barcode<TAB>cell``; cell ids stay strings."""
    df = spark.read.schema("cbc string, cell string").option("sep", "\t").option("header", False).csv(path)
    return df.select(F.lit(sample).alias("sample"), "cbc", "cell") if sample is not None else df


def read_whitelists(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several whitelist files in one scan -> (cbc_file, cbc, cell), cbc_file
    being the path as given."""
    uris = []
    for p in paths:
        fs, jpath = file_system(spark, p)
        uris.append((fs.makeQualified(jpath).toUri().toString(), p))
    rows = spark.read.schema("cbc string, cell string").option("sep", "\t").csv(list(paths))
    given = spark.createDataFrame(uris, "uri string, cbc_file string")
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    rows = rows.select(plain(F.col("_metadata.file_path")).alias("uri"), "cbc", "cell")
    return rows.join(F.broadcast(given.withColumn("uri", plain(F.col("uri")))), "uri").select("cbc_file", "cbc", "cell")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF text: everything from a ``#`` to the end of a line is a comment,
    lines left blank are skipped, nine tab-separated columns.

    Adds ``line_no``, a file-order key (file, split, position) used to pick
    the first ``gene`` row of a gene id.
    """
    t = spark.read.text(path).select(
        F.regexp_replace("value", "#.*$", "").alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("f"),
            F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("i"),
        ).alias("line_no"),
    )
    t = t.filter(F.trim(F.col("line")) != "")
    parts = F.split("line", "\t")
    cols = [F.get(parts, i).alias(c) for i, c in enumerate(GTF_COLUMNS)]
    df = t.select(*cols, "line_no")
    return df.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long"))


def read_sam(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """SAM text -> alignment rows (sample, qname, flag, rname, pos, mapq,
    cigar); header lines (``@``) are skipped."""
    t = spark.read.text(path).filter(~F.col("value").startswith("@"))
    p = F.split("value", "\t")
    df = t.select(
        F.get(p, 0).alias("qname"), F.get(p, 1).cast("int").alias("flag"), F.get(p, 2).alias("rname"),
        F.get(p, 3).cast("long").alias("pos"), F.get(p, 4).cast("int").alias("mapq"), F.get(p, 5).alias("cigar"),
    )
    return df.select(F.lit(sample).alias("sample"), "*") if sample is not None else df


HEAD_BYTES = 64 << 10  # bytes read at a time from the head of a SAM file


def _contigs(batches):
    """(contig, place) of the files' ``@SQ`` lines; a file is read up to the
    first line that is no header line."""
    import pyarrow as pa

    for batch in batches:
        for path in batch.column("path").to_pylist():
            lines, names, more = members.Lines(path, piece=HEAD_BYTES), [], True
            while more and (some := lines.take(1000).to_pylist()):
                for line in some:
                    more = line.startswith(b"@")
                    if not more:
                        break
                    found = re.search(rb"\tSN:([^\t\r\n]+)", line) if line.startswith(b"@SQ") else None
                    names += [found.group(1).decode()] if found else []
            lines.close()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(range(1, len(names) + 1), pa.int64())], names=["contig", "place"])


def read_contigs(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """Contig names of the ``@SQ`` header lines of SAM files (plain or gzip; a
    file, a folder or a pattern), with their ``place`` in the header. Only the
    heads of the files are read, however long they are."""
    members.pickle_by_value(sys.modules[__name__])
    fs, jpath = file_system(spark, path)
    found = [f for top in (fs.globStatus(jpath) or []) for f in (fs.listStatus(top.getPath()) if top.isDirectory() else [top])]
    files = sorted(str(f.getPath().toString()) for f in found if f.isFile() and str(f.getPath().getName())[0] not in "._")
    if not files:
        raise FileNotFoundError(path)
    listed = spark.createDataFrame([(i, f) for i, f in enumerate(files)], "i int, path string").repartitionById(len(files), "i")
    df = listed.select("path").mapInArrow(_contigs, "contig string, place long")
    return df.select(F.lit(sample).alias("sample"), "contig", "place") if sample is not None else df


def file_place() -> Column:
    """Where a row stands in its file: sorts by place within a file."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"))


def numbered(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` of files with ``place``, their number (from 1) in order of file
    name and position, for each value of ``keys``. Rows are ranked inside their
    split of a file; the rows of earlier splits are added from a table of splits."""
    at = rows.select("*", F.col("_metadata.file_path").alias("_file"), file_place().alias("_at"))
    split = [*keys, "_file", "_block"]
    at = at.withColumn("_block", F.col("_at.block"))
    earlier = Window.partitionBy(*keys).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    n = at.groupBy(*split).agg(F.count("*").alias("_n"))
    before = n.select(*split, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*split).orderBy("_at"))
    same = [c.eqNullSafe(before[k]) for k in split for c in [F.col(f"r.{k}")]]
    joined = at.withColumn("_rank", rank).alias("r").join(before, same)
    return joined.select("r.*", (F.col("_before") + F.col("_rank")).cast("long").alias("place")).drop("_file", "_at", "_block", "_rank")


def ordered(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` of files with ``in_order``: whether a row's ``keys`` are not
    less than those of the row before it, in order of file name and position
    (nulls first). Compared inside files, and with the last row of the file before."""
    key = F.struct(*[F.col(k) for k in keys])
    at = rows.select("*", F.col("_metadata.file_path").alias("_file"), file_place().alias("_at"), key.alias("_key"))
    last = at.groupBy("_file").agg(F.max_by("_key", "_at").alias("_last"))
    before = last.select(F.col("_file").alias("_of"), F.lag("_last").over(Window.orderBy("_file")).alias("_earlier"))  # a row per file
    prev = F.coalesce(F.lag("_key").over(Window.partitionBy("_file").orderBy("_at")), F.col("_earlier"))
    out = at.join(before, F.col("_file") == F.col("_of")).withColumn("in_order", F.coalesce(F.col("_key") >= prev, F.lit(True)))
    return out.drop("_file", "_of", "_at", "_key", "_earlier")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A matrix as ``sinks.files.write_matrices`` writes it: gene and a column
    per cell, as strings. The header is the first line of the first part."""
    lines = spark.read.text(path)
    header = numbered(lines).where("place = 1").first().value
    parts = F.split("value", "\t")
    names = header.split("\t")
    return lines.where(F.col("value") != header).select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Exon or intron table: headerless TSV chr, start, end, strand, gene."""
    return spark.read.schema(FEATURE_SCHEMA).option("sep", "\t").csv(path)


def read_overlap_table(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned overlap rows as :func:`celltally.sinks.files.write_overlaps`
    writes them (Parquet by sample and label, ids kept as strings)."""
    schema = "chrom string, start long, end long, qname string, strand string, gene_fullname string, sample string, label string"
    return spark.read.schema(schema).parquet(path)


def read_overlaps(spark: SparkSession, intron_path: str, exon_path: str, sample: str | None = None) -> DataFrame:
    """Cleaned overlap files (6-column TSV) united with a ``label``."""
    def one(path, label):
        df = spark.read.schema(OVERLAP_SCHEMA).option("sep", "\t").csv(path)
        return df.select(F.lit(sample).alias("sample"), F.lit(label).alias("label"), *df.columns)

    return one(intron_path, "intron").unionByName(one(exon_path, "exon"))
