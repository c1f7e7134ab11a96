"""

Each takes (spark, sf_dir) and returns a DataFrame over the fixture views
derived from the driver's tables (``celltally.fixtures``). The matching
DuckDB SQL is in ``celltally.oracle_queries``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltally import fixtures as fx
from celltally.functions.barcodes import parse_name, parse_tag_name, split_barcode
from celltally.operators import annotation as ann
from celltally.operators import barcodes as bc
from celltally.operators import counts as cnt
from celltally.operators import intervals as iv
from celltally.operators.nearest import observed_dictionary
from celltally.operators.sweep import sweep_join
from celltally.plans import steps
from celltally.session import file_system, scratch_path
from celltally.sinks import files as sinks
from celltally.sources import fastq as fq
from celltally.sources import text as txt

LEN_CBC, LEN_UMI, UMI_FIRST = 6, 6, True  # run defaults of the original tool
FIXTURE_FASTQ_CHUNK = 20_000
TABLE_ROWS = 2_000  # blocks of a stretch in one bucket, so that the fixture has salted ones
SWEEP_ROWS = 50_000  # blocks of a slot, so that the fixture has several
CELLS = [f"{i + 1:03d}" for i in range(fx.N_CELLS)]  # cell columns of the fixture's matrices
ROUND = 6  # decimals reported for transcript estimates

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- helpers

def gtf_rows(spark, d) -> DataFrame:
    g = fx.fx_gtf(spark, d)
    return g.select(
        "seqname", "source", "feature", F.col("start_").alias("start"), F.col("end_").alias("end"),
        F.lit(".").alias("score"), "strand", F.lit(".").alias("frame"), "attribute",
    )


def annotation(spark, d) -> steps.Annotation:
    return steps.annotate(gtf_rows(spark, d))


def counted(spark, d, mode: str = "one") -> steps.Counted:
    a = annotation(spark, d)
    return steps.count(fx.fx_aligned(spark, d, mode), a.exons, a.introns)


def pairs(spark, d, mode: str = "one") -> DataFrame:
    return bc.pair_reads(fx.fx_r1(spark, d, mode), fx.fx_r2(spark, d, mode))


def barcoded(spark, d, mode: str = "one") -> steps.Barcoded:
    return steps.barcode(pairs(spark, d, mode), fx.fx_whitelist(spark, d),
                         steps.BarcodeParams(len_cbc=LEN_CBC, len_umi=LEN_UMI, umi_first=UMI_FIRST, hd=0))


# ------------------------------------------------------ sources and checks

@query
def manifest_scan(spark, d):
    path = scratch_path(spark, "manifest")
    fx.fx_manifest(spark, d).write.option("header", True).csv(path)
    return txt.read_manifest(spark, path)


@query
def whitelist_scan(spark, d):
    path = scratch_path(spark, "whitelist")
    fx.fx_whitelist(spark, d).write.option("sep", "\t").csv(path)
    return txt.read_whitelist(spark, path)


@query
def fastq_pairs(spark, d):
    base = scratch_path(spark, "fastq")
    for r, df in (("R1", fx.fx_r1(spark, d)), ("R2", fx.fx_r2(spark, d))):
        rec = df.select("rec_no", F.concat(F.lit("@"), "name", F.lit(" 1:N:0:1")).alias("name"), "seq", "plus", "qual")
        sinks.write_fastq_chunks(rec, f"{base}/S1_{r}", FIXTURE_FASTQ_CHUNK)
    items = fq.chunk_pairs(spark, f"{base}/S1_R1", f"{base}/S1_R2", "S1")
    p = fq.read_fastq_pairs(spark, items)
    return p.select("rec_no", "r1_name", "r1_seq", "r1_plus", "r1_qual", "r2_name", "r2_seq", "r2_plus", "r2_qual")


def joined_files(spark, folder: str, path: str) -> str:
    """The chunk files of a folder one after another in one gzip file."""
    fs, out = file_system(spark, path)
    stream = fs.create(out)
    for chunk in sorted(fq.listed(spark, folder), key=lambda c: int(c.rsplit("=", 1)[1]) if "chunk=" in c else -1):
        for f in (f for f in fq.listed(spark, chunk) if "/part-" in f):
            part = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f))
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, stream, 1 << 16, False)
            part.close()
    stream.close()
    return path


@query
def fastq_members(spark, d):
    """A pair of files of many gzip members each, whose members hold different records."""
    base, files = scratch_path(spark, "fastq-members"), {}
    n = fx.table(spark, d, "lineitem").count()
    for r, df, members in (("R1", fx.fx_r1(spark, d), 20), ("R2", fx.fx_r2(spark, d), 7)):
        rec = df.select("rec_no", F.concat(F.lit("@"), "name", F.lit(" 1:N:0:1")).alias("name"), "seq", "plus", "qual")
        sinks.write_fastq_chunks(rec, f"{base}/S1_{r}", -(-n // members))
        files[r.lower()] = joined_files(spark, f"{base}/S1_{r}", f"{base}/S1_{r}.fq.gz")
    p = fq.read_fastq_pairs(spark, [{"sample": "S1", **files}], split_bytes=1)
    return p.select("rec_no", "r1_name", "r1_seq", "r1_plus", "r1_qual", "r2_name", "r2_seq", "r2_plus", "r2_qual")


@query
def gtf_scan(spark, d):
    path = scratch_path(spark, "gtf")
    fx.fx_gtf_text(spark, d).write.text(path)
    return txt.read_gtf(spark, path).drop("line_no")


@query
def check_whitelist(spark, d):
    v = bc.check_whitelist(fx.fx_whitelist_bad(spark, d), LEN_CBC)
    return v.select("cbc", "cell", F.col("len").cast("long").alias("len"))


@query
def check_pairs(spark, d):
    p = bc.pair_reads(fx.fx_r1(spark, d), fx.fx_r2_bad(spark, d))
    return bc.check_pairs(p)


def sam_file(spark, d) -> str:
    """The fixture's alignments as SAM text: a folder whose first file is the
    header, in order; the alignments follow in files as they come."""
    a = fx.fx_aligned(spark, d)
    tab, text = F.lit("\t"), lambda c: F.col(c).cast("string")
    body = a.select(F.concat_ws("\t", "qname", text("flag"), "rname", text("pos"), text("mapq"), "cigar", F.lit("*"), F.lit("0")).alias("line"))
    names = a.groupBy().agg(F.reverse(F.array_sort(F.collect_set("rname"))).alias("c")).select(F.posexplode("c").alias("at", "c"))
    sq = names.select((F.col("at") + 1).alias("at"), F.concat(F.lit("@SQ"), tab, F.lit("SN:"), "c", tab, F.lit("LN:100000000")).alias("line"))
    first = spark.createDataFrame([(0, "@HD\tVN:1.6\tSO:unsorted"), (1000, "@PG\tID:x\tCL:map SN:none")], "at int, line string")
    head = first.unionByName(sq).coalesce(1).sortWithinPartitions("at").select("line")
    path = scratch_path(spark, "sam")
    head.unionByName(body).write.text(path)
    return path


@query
def sam_scan(spark, d):
    return txt.read_sam(spark, sam_file(spark, d), "S1")


@query
def contigs_scan(spark, d):
    return txt.read_contigs(spark, sam_file(spark, d))


@query
def contig_filter(spark, d):
    a = annotation(spark, d)
    return steps.count(fx.fx_aligned(spark, d), a.exons, a.introns, contigs=fx.fx_contigs(spark, d)).clean


# ---------------------------------------------------------------- barcodes

@query
def barcode_split(spark, d):
    r1 = fx.fx_r1(spark, d)
    bcseq, umi, cbc = split_barcode("seq", LEN_CBC, LEN_UMI, UMI_FIRST)
    return r1.select("rec_no", bcseq.alias("bcseq"), umi.alias("umi"), cbc.alias("cbc"))


@query
def barcode_strip(spark, d):
    # barcode read and biological read are both R1
    p = pairs(spark, d)
    s = bc.split_reads(p, bc_read="R1", bio_read="R1", len_cbc=LEN_CBC, len_umi=LEN_UMI, umi_first=UMI_FIRST)
    return s.select("rec_no", "seq", "qual")


@query
def barcode_expand_hd0(spark, d):
    return bc.barcode_dictionary(fx.fx_whitelist(spark, d), 0)


@query
def barcode_expand_hd1(spark, d):
    return bc.barcode_dictionary(fx.fx_whitelist(spark, d), 1)


@query
def barcode_nearest_hd2(spark, d):
    r1 = fx.fx_r1(spark, d)
    _, _, cbc = split_barcode("seq", LEN_CBC, LEN_UMI, UMI_FIRST)
    observed = r1.select(cbc.alias("cbc")).distinct()
    return bc.assign_cells(observed, bc.barcode_dictionary(fx.fx_whitelist(spark, d), 2)).select("cbc", "cell")


def _indexed(hd: int) -> Query:
    def run(spark, d):
        _, _, cbc = split_barcode("seq", LEN_CBC, LEN_UMI, UMI_FIRST)
        found = observed_dictionary(fx.fx_r1(spark, d).select(cbc.alias("cbc")), fx.fx_whitelist(spark, d), hd)
        return found.select(F.col("seq").alias("cbc"), "cell")

    run.__name__ = f"barcode_index_hd{hd}"
    return run


for _hd in (2, 3):
    query(_indexed(_hd))


@query
def barcode_read_r2(spark, d):
    """The barcode is on R2, the cell before the UMI, and R1 is the biological read."""
    p = pairs(spark, d).select("sample", "rec_no", *[F.col(f"r{3 - i}_{c}").alias(f"r{i}_{c}") for i in (1, 2) for c in ("name", "seq", "plus", "qual")])
    b = steps.barcode(p, fx.fx_whitelist(spark, d), steps.BarcodeParams("R2", "R1", LEN_CBC, LEN_UMI, umi_first=False, hd=1))
    return b.records


@query
def barcode_assign(spark, d):
    b = barcoded(spark, d)
    return b.assigned.filter(F.col("cell").isNotNull()).select("sample", "rec_no", "cbc", "cell")


@query
def barcoded_reads(spark, d):
    return barcoded(spark, d).records


@query
def read_stats(spark, d):
    return barcoded(spark, d, "two").stats


# -------------------------------------------------------------- annotation

@query
def gtf_attributes(spark, d):
    w = ann.widen(gtf_rows(spark, d), ["gene_id", "gene_name", "gene_biotype", "tag"])
    return w.select("seqname", "feature", "start", "end", "strand", "gene_id", "gene_name", "gene_biotype", "tag")


@query
def gtf_wide(spark, d):
    return ann.widen_all(gtf_rows(spark, d))


@query
def gtf_keys(spark, d):
    return ann.attribute_keys(gtf_rows(spark, d))


@query
def gene_table(spark, d):
    return annotation(spark, d).genes


@query
def exon_table(spark, d):
    return annotation(spark, d).exons


@query
def intron_table(spark, d):
    return annotation(spark, d).introns


@query
def feature_pool(spark, d):
    exons, introns = ann.exon_intron_tables(gtf_rows(spark, d), pooled=False)
    both = exons.withColumn("kind", F.lit("exon")).unionByName(introns.withColumn("kind", F.lit("intron")))
    return ann.pool_features(both, "kind", counted=True)


# --------------------------------------------------------------- intervals

@query
def align_blocks(spark, d):
    return iv.align_blocks(fx.fx_aligned(spark, d))


@query
def overlap_exon(spark, d):
    return counted(spark, d).overlaps.filter(F.col("label") == "exon").drop("label")


@query
def overlap_intron(spark, d):
    return counted(spark, d).overlaps.filter(F.col("label") == "intron").drop("label")


@query
def overlap_sweep(spark, d):
    """Exons and introns at once, both sides dealt by ranges of the genome."""
    a = annotation(spark, d)
    unique = iv.align_blocks(fx.fx_aligned(spark, d)).filter(F.col("mapq") == iv.UNIQUE_MAPQ)
    return sweep_join(unique, iv.label_features(a.exons, a.introns), SWEEP_ROWS).dropDuplicates(iv.OVERLAP_COLS)


@query
def exon_only(spark, d):
    return counted(spark, d, "two").clean.filter(F.col("label") == "exon").drop("label")


@query
def intron_only(spark, d):
    return counted(spark, d, "two").clean.filter(F.col("label") == "intron").drop("label")


@query
def label_union(spark, d):
    return counted(spark, d).clean


# ------------------------------------------------------------------ counts

@query
def name_parse(spark, d):
    umi, cell = parse_name("qname")
    return fx.fx_aligned(spark, d).select("qname", umi.alias("umi"), cell.alias("cell"))


@query
def name_parse_tags(spark, d):
    cell, umi = parse_tag_name("h")
    return fx.fx_tag_names(spark, d).select("h", cell.alias("cell"), umi.alias("umi"))


@query
def molecules(spark, d):
    return counted(spark, d).molecules


def _measures(spark, d, family):
    c = counted(spark, d).counts
    cols = [F.round(m, ROUND).alias(m) if family == "transcripts" else F.col(m) for m in cnt.MEASURES[family]]
    return c.select("sample", "cell", "gene", *cols)


@query
def counts_reads(spark, d):
    return _measures(spark, d, "reads")


@query
def counts_umis(spark, d):
    return _measures(spark, d, "umis")


@query
def counts_transcripts(spark, d):
    return _measures(spark, d, "transcripts")


@query
def counts_bucketed(spark, d):
    """UMI counts from overlap rows bucketed by interval, as a run makes them."""
    a = annotation(spark, d)
    rows = steps.count(fx.fx_aligned(spark, d), a.exons, a.introns).table(rows_per_bucket=TABLE_ROWS)
    return cnt.gene_cell_counts(rows.molecules).select("sample", "cell", "gene", *cnt.MEASURES["umis"])


@query
def gene_rowcounts(spark, d):
    return cnt.gene_rowcounts(counted(spark, d).clean)


@query
def overlap_summary(spark, d):
    return cnt.overlap_summary(counted(spark, d, "two").clean)


@query
def qc_summary(spark, d):
    stats = barcoded(spark, d, "two").stats
    summ = cnt.overlap_summary(counted(spark, d, "two").clean)
    return stats.join(summ, "sample", "full")


# ------------------------------------------------------------------- sinks
# Each writes its files and reads them back; ``place`` is a row's place in them.

@query
def sink_features(spark, d):
    path = scratch_path(spark, "sink-exons")
    sinks.write_features(annotation(spark, d).exons, path)
    return txt.numbered(txt.read_features(spark, path), "chr")


@query
def sink_overlaps(spark, d):
    path = scratch_path(spark, "sink-overlaps")
    sinks.write_overlaps(counted(spark, d, "two").clean, path)
    return txt.read_overlap_table(spark, path).select("sample", "label", "chrom", "start", "end", "qname", "strand", "gene_fullname")


@query
def sink_gene_counts(spark, d):
    path = scratch_path(spark, "sink-gene-counts")
    sinks.write_gene_counts(cnt.gene_rowcounts(counted(spark, d, "two").clean), path)
    t = txt.numbered(spark.read.text(path), "label")
    part = lambda i: F.split_part("value", F.lit("\t"), F.lit(i))
    return t.select("label", part(1).alias("sample"), part(2).alias("gene"), part(3).cast("long").alias("n"), "place")


@query
def sink_fastq(spark, d):
    path = scratch_path(spark, "sink-fastq")
    sinks.write_fastq(barcoded(spark, d, "two").records, path)
    files = [f for folder in fq.listed(spark, path) for f in fq.listed(spark, folder) if "/part-" in f]
    back = fq.read_fastq(spark, files)
    return back.select(F.regexp_extract("file", "sample=([^/]+)", 1).alias("sample"), "name", "seq", "plus", "qual")


@query
def sink_genes(spark, d):
    path = scratch_path(spark, "sink-genes")
    genes = annotation(spark, d).genes
    sinks.write_genes(genes, path)
    back = spark.read.schema(genes.schema).option("sep", "\t").option("header", True).csv(path)
    return txt.ordered(back, "seqname", "start")


@query
def sink_alignments(spark, d):
    path = scratch_path(spark, "sink-alignments")
    sinks.write_alignments(iv.align_blocks(fx.fx_aligned(spark, d)), path)
    rows = spark.read.parquet(path)
    return txt.ordered(rows, "sample", "chrom", "start", "end").select("sample", "chrom", "start", "end", "qname", "mapq", "strand", "in_order")


@query
def sink_matrices(spark, d):
    """All nine matrices; estimates are given in millionths."""
    path = scratch_path(spark, "sink-matrices")
    sinks.write_matrices(cnt.matrix_lines(counted(spark, d).counts), path)
    t = txt.numbered(spark.read.schema("value string, sample string, measure string").text(path), "sample", "measure")
    cut = F.split("value", "\t")
    millionths = F.transform(F.slice(cut, F.lit(2), F.size(cut)), lambda v: F.round(v.cast("double") * 1_000_000).cast("long").cast("string"))
    line = F.when(F.startswith("measure", F.lit("transcripts")) & (F.col("place") > 1), F.array_join(F.concat(F.array(cut[0]), millionths), "\t")).otherwise(F.col("value"))
    return t.select("sample", "measure", line.alias("line"), "place")


# ---------------------------------------------------------------- matrices

def _matrix(measure: str) -> Query:
    def run(spark, d):
        counts = counted(spark, d).counts
        if measure.startswith("transcripts"):
            counts = counts.withColumn(measure, F.round(measure, ROUND))
        return cnt.pivot_matrix(counts, measure, CELLS)

    run.__name__ = f"matrix_{measure}"
    return run


for _m in [m for fam in ("reads", "umis", "transcripts") for m in cnt.MEASURES[fam]]:
    query(_matrix(_m))
