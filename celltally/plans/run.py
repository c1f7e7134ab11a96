"""A whole run driven by a manifest: every sample in one set of jobs.

Reads the manifest (sample, raw_fq_dir, cbc_file), the per-sample whitelists
and FASTQ file pairs, the annotation (GTF, or existing exon and intron tables)
and the aligned reads, and writes:

* ``<out>/assigned/`` - every read with its cell, Parquet by sample: the FASTQ
  files are decoded once, the next two come from here;
* ``<out>/barcoded/sample=<id>/`` - barcoded FASTQ (gzip);
* ``<out>/read_stats/`` - per sample reads, matched reads, ratio, records
  without a mate, and the parameters of the run;
* ``<out>/annotation/{genes,exons,introns}`` - interval tables (from a GTF);
* ``<out>/overlaps/`` - cleaned overlap rows (Parquet by sample and label);
* ``<out>/counts/`` - long table with the nine measures per (sample, cell, gene);
* ``<out>/matrices/sample=<id>/measure=<name>/`` - the nine matrices as text;
* ``<out>/summary/``, ``<out>/gene_counts/``, ``<out>/qc/`` - summaries.

A run stops, and names the culprit, if files of a sample or a chunk are
missing, a whitelist barcode has another length, or a read pair breaks the
input rules.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltally.operators import barcodes as bcs
from celltally.operators import counts as cnt
from celltally.plans import steps
from celltally.session import drop_scratch, scratch_mark
from celltally.sinks import files as sinks
from celltally.sources import fastq as fq
from celltally.sources import text as txt


@dataclass
class RunResult:
    """What a run wrote, read back: statistics per sample, cleaned overlap
    rows, molecules, and the long table of the nine measures."""

    stats: DataFrame
    clean: DataFrame
    molecules: DataFrame
    counts: DataFrame


def whitelists(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(sample, cbc, cell) for every sample, each from its own cbc_file; all
    files are read in one scan."""
    files = sorted(r.cbc_file for r in manifest.select("cbc_file").distinct().collect())  # one per sample at most
    return manifest.select("sample", "cbc_file").join(txt.read_whitelists(spark, files), "cbc_file").select("sample", "cbc", "cell")


def read_pairs(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One partition per FASTQ file pair over all samples of the manifest.
    Records without a mate come with nulls. A sample without files is an error."""
    items, missing = [], []
    for r in manifest.collect():  # one row per sample: a bounded list
        try:
            items += fq.sample_pairs(spark, r.raw_fq_dir, r.sample)
        except FileNotFoundError as e:
            missing.append(str(e))
    if missing or not items:
        raise FileNotFoundError("; ".join(missing) or "the manifest names no sample")
    return fq.read_fastq_pairs(spark, items, tail=True)


def barcode_reads(spark: SparkSession, manifest_path: str, out: str, params: steps.BarcodeParams, write_fastq: bool = True) -> DataFrame:
    """Assign the reads of all samples; returns the read statistics."""
    manifest = txt.read_manifest(spark, manifest_path)
    listed = whitelists(spark, manifest)
    bcs.require_empty(bcs.check_whitelist(listed, params.len_cbc), f"a whitelist barcode is not {params.len_cbc} bases long")
    pairs = read_pairs(spark, manifest)
    mated = F.col("r1_name").isNotNull() & F.col("r2_name").isNotNull()
    sides = [c for c in pairs.columns if c.startswith(("r1_", "r2_"))]
    pairs = bcs.checked_pairs(pairs).select("sample", "rec_no", *[F.when(mated, F.col(c)).alias(c) for c in sides])
    assigned = steps.barcode(pairs, listed, params).assigned.withColumn("mated", F.col("name").isNotNull())
    path = f"{out}/assigned"
    assigned.write.mode("overwrite").partitionBy("sample").parquet(path)
    assigned = spark.read.schema(assigned.schema).parquet(path)
    paired = assigned.where("mated")
    if write_fastq:
        sinks.write_fastq(bcs.barcoded_records(paired), f"{out}/barcoded")
    tails = assigned.groupBy("sample").agg(F.count_if(~F.col("mated")).alias("n_unpaired"))
    stats = bcs.read_stats(paired).join(tails, "sample", "right")
    stats = stats.withColumn("parameters", F.struct(*[F.lit(v).alias(k) for k, v in asdict(params).items()]))
    sinks.write_table(stats, f"{out}/read_stats", "json")
    return spark.read.schema(stats.schema).json(f"{out}/read_stats")


def write_counts(spark: SparkSession, clean: DataFrame, out: str, umi_length: int, molecules: DataFrame | None = None) -> DataFrame:
    """Counts, matrices and summaries of cleaned overlap rows (and of their
    molecules, where they are at hand)."""
    sinks.write_table(cnt.gene_cell_counts(molecules or cnt.molecules(clean), umi_length), f"{out}/counts")
    counts = spark.read.parquet(f"{out}/counts")
    sinks.write_matrices(cnt.matrix_lines(counts), f"{out}/matrices")
    sinks.write_table(cnt.overlap_summary(clean), f"{out}/summary", "tsv")
    sinks.write_gene_counts(cnt.gene_rowcounts(clean), f"{out}/gene_counts")
    return counts


def count_overlaps(spark: SparkSession, overlaps: DataFrame, out: str, umi_length: int = cnt.DEFAULT_UMI_LENGTH) -> DataFrame:
    """Count from cleaned overlap rows that an earlier run wrote
    (``text.read_overlap_table``) or TSV files hold (``text.read_overlaps``)."""
    return write_counts(spark, overlaps, out, umi_length)


def run(spark: SparkSession, manifest_path: str, gtf_path: str | None, alignments: DataFrame, out: str,
        params: steps.BarcodeParams | None = None, contigs: DataFrame | None = None,
        write_fastq: bool = True, exons: str | None = None, introns: str | None = None) -> RunResult:
    """Barcode, annotate and count every sample of a manifest.

    ``alignments``: (sample, qname, flag, rname, pos, mapq, cigar) for all
    samples, e.g. ``read_sam`` per sample united, or an aligned-read table.
    Give ``gtf_path``, or ``exons`` and ``introns`` (tables of an earlier run).
    """
    if gtf_path is None and not (exons and introns):
        raise ValueError("a run needs a GTF or both an exon and an intron table")
    p = params or steps.BarcodeParams()
    out, since = out.rstrip("/"), scratch_mark(spark)
    stats = barcode_reads(spark, manifest_path, out, p, write_fastq)

    if not (exons and introns):
        ann = steps.annotate(txt.read_gtf(spark, gtf_path))
        exons, introns = f"{out}/annotation/exons", f"{out}/annotation/introns"
        sinks.write_genes(ann.genes, f"{out}/annotation/genes")
        sinks.write_features(ann.exons, exons)
        sinks.write_features(ann.introns, introns)

    res = steps.count(alignments, txt.read_features(spark, exons), txt.read_features(spark, introns), contigs=contigs, umi_length=p.len_umi)
    table = res.table()
    sinks.write_overlaps(table.clean, f"{out}/overlaps")
    clean = txt.read_overlap_table(spark, f"{out}/overlaps")
    counts = write_counts(spark, clean, out, p.len_umi, table.molecules)
    table.drop()
    qc = stats.select("sample", "n_reads", "n_matched", "frac", "n_unpaired").join(cnt.overlap_summary(clean), "sample", "full")
    sinks.write_table(qc, f"{out}/qc", "tsv")
    drop_scratch(spark, since)
    return RunResult(stats, clean, cnt.molecules(clean), counts)
