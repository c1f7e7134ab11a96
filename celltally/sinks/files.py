"""Sinks. Parquet is the main form; text forms (FASTQ, TSV) mirror the
files a user of the original tool expects. Every writer is a distributed
Spark write (one file per task); sorted outputs use a range-partitioned
global sort, never a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.operators.common import land

FASTQ_CHUNK = 1_000_000  # records per chunk folder of a written FASTQ set


def write_fastq(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records (name, seq, plus, qual) -> 4-line FASTQ text, gzip members; with
    a ``sample`` column one folder ``sample=<id>`` each."""
    line = F.concat_ws("\n", "name", "seq", "plus", "qual").alias("value")
    if "sample" in records.columns:
        out = records.select("sample", line).write.mode("overwrite").partitionBy("sample")
    else:
        out = records.select(line).write.mode("overwrite")
    out.option("compression", compression).text(path)


def write_fastq_chunks(records: DataFrame, path: str, chunk_size: int = FASTQ_CHUNK, compression: str = "gzip") -> None:
    """FASTQ split into folders of ``chunk_size`` records by rec_no, named
    ``chunk=<first rec_no>``, one file each in rec_no order, so two such sets
    pair up by folder (see ``sources.fastq.chunk_pairs``)."""
    df = records.withColumn("chunk", (F.floor(F.col("rec_no") / F.lit(chunk_size)) * chunk_size).cast("long"))
    (
        df.repartition("chunk")
        .sortWithinPartitions("chunk", "rec_no")
        .select("chunk", F.concat_ws("\n", "name", "seq", "plus", "qual").alias("value"))
        .write.mode("overwrite")
        .partitionBy("chunk")
        .option("compression", compression)
        .text(path)
    )


def write_tsv(df: DataFrame, path: str, header: bool = False, sort_by: list[str] | None = None) -> None:
    out = df.orderBy(*sort_by) if sort_by else df
    out.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def write_genes(genes: DataFrame, path: str) -> None:
    """Gene table with a header, sorted by seqname and start."""
    write_tsv(genes, path, header=True, sort_by=["seqname", "start"])


def write_features(features: DataFrame, path: str) -> None:
    """Exon or intron table, no header, sorted by chr, start (end, strand)."""
    write_tsv(features.select("chr", "start", "end", "strand", "gene_fullname"), path,
              sort_by=["chr", "start", "end", "strand"])


def write_overlaps(clean: DataFrame, path: str) -> None:
    """Cleaned overlap rows as Parquet, one folder per sample and label. Rows
    are dealt out by range of sample, label and position first, so a task
    writes a few folders only and files are sorted by position."""
    (
        clean.repartitionByRange("sample", "label", "chrom", "start")
        .sortWithinPartitions("sample", "label", "chrom", "start", "end")
        .write.mode("overwrite").option("compression", "zstd").partitionBy("sample", "label").parquet(path)
    )


def write_matrices(lines: DataFrame, path: str) -> None:
    """Matrix lines (see ``operators.counts.matrix_lines``) -> text folders
    ``sample=<id>/measure=<name>``: part files that, one after another, are the
    header and then the genes in order. A large matrix is several tasks' work,
    each a range of its genes; ``text.read_matrix`` reads one back."""
    gene = F.col("gene").asc_nulls_first()
    (
        lines.repartitionByRange("sample", "measure", gene)
        .sortWithinPartitions("sample", "measure", gene)
        .select("sample", "measure", F.col("line").alias("value"))
        .write.mode("overwrite").partitionBy("sample", "measure").text(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Any long result (counts, summaries, statistics, QC) as Parquet, JSON
    or TSV."""
    if fmt == "json":
        df.write.mode("overwrite").json(path)
    elif fmt == "tsv":
        write_tsv(df, path, header=True)
    else:
        df.write.mode("overwrite").parquet(path)


def write_gene_counts(gene_rows: DataFrame, path: str, labels: tuple[str, ...] = ("intron", "exon")) -> None:
    """Per-gene row counts -> ``label=<label>`` folders of TSV (sample, gene, n),
    sorted over all files of a folder by sample, then largest first. One write
    per label: a partitioned write would sort again by its folders only. The
    counts, a row per gene, are written first, not made again for each label."""
    gene_rows = land(gene_rows, "gene-rows")
    for label in labels:
        (
            gene_rows.where(F.col("label") == label).select("sample", "gene", "n")
            .orderBy("sample", F.desc("n"), "gene")
            .write.mode("overwrite").option("sep", "\t").csv(f"{path.rstrip('/')}/label={label}")
        )


def write_alignments(blocks: DataFrame, path: str) -> None:
    """Alignment blocks sorted by coordinate: range-partitioned on
    (sample, chrom, start) and sorted inside each partition."""
    (
        blocks.repartitionByRange("sample", "chrom", "start")
        .sortWithinPartitions("sample", "chrom", "start", "end")
        .write.mode("overwrite").parquet(path)
    )
