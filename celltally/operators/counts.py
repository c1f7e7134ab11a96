"""Read, molecule (UMI) and transcript counts per gene and cell.

Everything stays long: one row per (sample, cell, gene). Matrices are a
pivot of that table for export only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.functions.barcodes import parse_name
from celltally.functions.counting import gene_key, umi_to_transcripts
from celltally.operators.common import broadcast_if_small, land

DEFAULT_UMI_LENGTH = 6
MEASURES = {
    "reads": ["reads_unspliced", "reads_spliced", "reads_total"],
    "umis": ["umis_unspliced", "umis_spliced", "umis_total"],
    "transcripts": ["transcripts_unspliced", "transcripts_spliced", "transcripts_total"],
}


def tag_rows(rows: DataFrame) -> DataFrame:
    """Overlap rows -> (sample, label, chrom, start, end, cell, gene, umi).

    ``gene`` is ``<gene_fullname>__<chrom>``; UMI and cell come from the read
    name (third field from the end and last field). Keeping the interval
    lets the anti-join verdict be applied to these narrow rows."""
    umi, cell = parse_name("qname")
    return rows.select("sample", "label", "chrom", "start", "end", cell.alias("cell"),
                       gene_key("gene_fullname", "chrom").alias("gene"), umi.alias("umi"))


def collapsed_rows(overlaps: DataFrame, dedup: bool = True) -> DataFrame:
    """Overlap rows -> (sample, label, chrom, start, end, cell, gene, umi, n):
    repeated rows removed, then copies of one molecule on one interval counted.

    One exchange on interval, cell and UMI serves both steps (a hot locus is
    spread by cell and UMI); 128 bits of the read's name go through it, not the name.
    """
    keys = ["sample", "label", "chrom", "start", "end", "cell", "umi"]
    umi, cell = parse_name("qname")
    same = [F.unhex(F.md5("qname")).alias("read"), "strand"] if dedup else []
    t = overlaps.select(*keys[:5], cell.alias("cell"), umi.alias("umi"), "gene_fullname", *same)
    # without sample and label: a literal among the keys would cost the two
    # aggregates their use of this exchange
    t = t.repartition("chrom", "start", "end", "cell", "umi")
    if dedup:
        t = t.dropDuplicates()
    return t.withColumn("gene", gene_key("gene_fullname", "chrom")).groupBy(*keys, "gene").agg(F.count(F.lit(1)).alias("n"))


def molecules(clean: DataFrame) -> DataFrame:
    """One row per (sample, cell, gene, umi) with its intron and exon row
    counts. UMIs compare exactly (``N`` included). Accepts overlap rows, rows
    already passed through :func:`tag_rows`, or :func:`collapsed_rows`."""
    t = clean if "umi" in clean.columns else tag_rows(clean)
    n = F.col("n") if "n" in t.columns else F.lit(1)
    return t.groupBy("sample", "cell", "gene", "umi").agg(
        F.sum(F.when(F.col("label") == "intron", n).otherwise(0)).cast("long").alias("n_intron"),
        F.sum(F.when(F.col("label") == "exon", n).otherwise(0)).cast("long").alias("n_exon"),
    )


def gene_cell_counts(mol: DataFrame, umi_length: int = DEFAULT_UMI_LENGTH) -> DataFrame:
    """All nine measures per (sample, cell, gene) in one aggregation.

    reads_*: overlap rows (one per block and feature) by label;
    umis_unspliced: UMIs with any intron row; umis_spliced: UMIs with none;
    umis_total: distinct UMIs; transcripts_*: saturation estimate of each
    UMI count (the unspliced and spliced estimates do not add up to total).
    """
    c = mol.groupBy("sample", "cell", "gene").agg(
        F.sum("n_intron").alias("reads_unspliced"),
        F.sum("n_exon").alias("reads_spliced"),
        F.sum(F.col("n_intron") + F.col("n_exon")).alias("reads_total"),
        F.count_if(F.col("n_intron") > 0).alias("umis_unspliced"),
        F.count_if(F.col("n_intron") == 0).alias("umis_spliced"),
        F.count(F.lit(1)).alias("umis_total"),
    )
    return c.select(
        "*",
        *[umi_to_transcripts(u, umi_length).alias(t) for u, t in zip(MEASURES["umis"], MEASURES["transcripts"])],
    )


def overlap_summary(clean: DataFrame) -> DataFrame:
    """Per sample: intron rows, exon rows and their sum."""
    return clean.groupBy("sample").agg(
        F.count_if(F.col("label") == "intron").alias("intron_reads"),
        F.count_if(F.col("label") == "exon").alias("exon_reads"),
        F.count(F.lit(1)).alias("total_reads"),
    )


def gene_rowcounts(clean: DataFrame) -> DataFrame:
    """Rows per (sample, label, gene_fullname); the sink sorts them."""
    return (
        clean.groupBy("sample", "label", F.col("gene_fullname").alias("gene"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def matrix_axes_filter(counts: DataFrame, measure: str) -> DataFrame:
    """Rows that define the axes of a matrix.

    Read-count matrices by label hold only genes and cells having rows of
    that label; all other matrices hold every gene and cell of the sample."""
    if measure in ("reads_unspliced", "reads_spliced"):
        return counts.filter(F.col(measure) > 0)
    return counts


def matrix_cells(counts: DataFrame, measure: str) -> list[str]:
    """Sorted cell ids of a matrix (one per barcode of the whitelist)."""
    return sorted(r[0] for r in matrix_axes_filter(counts, measure).select("cell").distinct().collect())


def pivot_matrix(counts: DataFrame, measure: str, cells: list[str] | None = None) -> DataFrame:
    """Genes x cells matrix of one measure (sample, gene, <cell>...), zero
    where a gene has no count in a cell; cell columns in string order. Any
    cell id will do. For files, :func:`matrix_lines` has no column per cell."""
    if cells is None:
        counts = land(counts, "counts")
        cells = matrix_cells(counts, measure)
    rows = matrix_axes_filter(counts, measure)
    zero = F.lit(0.0 if measure.startswith("transcripts") else 0)
    wide = rows.groupBy("sample", "gene").pivot("cell", cells).agg(F.sum(measure))
    quoted = ["`" + c.replace("`", "``") + "`" for c in cells]
    return wide.select("sample", "gene", *[F.coalesce(F.col(q), zero).alias(c) for q, c in zip(quoted, cells)])


def matrix_lines(counts: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """(sample, measure, gene, line): the text lines of all matrices of all
    samples in one grouped pass; the header line has a null gene.

    A line holds the gene and, tab-separated, one value per cell of the
    matrix, in string order of the cells. The cells get their numbers from a
    small table; a gene's entries, all measures side by side, are exchanged
    once and sit in order of their cell's number. The zeros between two of them
    are filled in by repetition, so any number of cells works and the work
    follows the entries.
    """
    names = measures or [m for fam in MEASURES.values() for m in fam]
    own = [m for m in ("reads_unspliced", "reads_spliced") if m in names]  # matrices with their own axes
    counts = land(counts.select("sample", "cell", "gene", *names), "matrix-counts")
    on = counts.where("cell IS NOT NULL").groupBy("sample", "cell").agg(F.count(F.lit(1)).alias("n"), *[F.max((F.col(m) > 0).cast("int")).alias(f"on_{m}") for m in own])
    upto = Window.partitionBy("sample").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    at = [(F.count(F.lit(1)).over(upto) - 1).cast("int").alias("at"),
          *[F.when(F.col(f"on_{m}") > 0, F.sum(f"on_{m}").over(upto) - 1).cast("int").alias(f"at_{m}") for m in own]]
    axis = land(on.select("sample", "cell", *at), "matrix-cells")
    place = {m: f"at_{m}" if m in own else "at" for m in names}
    held = {m: f"e_{m}" if m in own else "e" for m in names}
    entry = F.struct(*axis.columns[2:], *names)
    genes = counts.join(broadcast_if_small(axis), ["sample", "cell"]).groupBy("sample", "gene").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    width = axis.groupBy("sample").agg(*[F.count(c).cast("int").alias(f"n_{c}") for c in axis.columns[2:]])
    above = lambda m: lambda x: x[m] > 0
    genes = genes.join(broadcast_if_small(width), "sample").select("*", *[F.filter("e", above(m)).alias(held[m]) for m in own])

    def line(m):
        e, p, zero = F.col(held[m]), place[m], F.lit("\t0.0" if m.startswith("transcripts") else "\t0")
        before = lambda i: F.when(i > 0, e[i - 1][p]).otherwise(F.lit(-1))
        values = F.transform(e, lambda x, i: F.concat(F.repeat(zero, x[p] - before(i) - 1), F.lit("\t"), x[m].cast("string")))
        tail = F.repeat(zero, F.col(f"n_{p}") - 1 - F.try_element_at(e, F.lit(-1))[p])
        return F.struct(F.lit(m).alias("measure"), (F.size(e) > 0).alias("on_axis"), F.concat(F.col("gene"), F.array_join(values, ""), tail).alias("line"))

    rows = genes.select("sample", "gene", F.inline(F.array(*[line(m) for m in names]))).where("on_axis").select("sample", "measure", "gene", "line")
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.when(F.col(place[m]).isNotNull(), F.col("cell")).alias("cell")) for m in names])
    header = axis.select("sample", F.inline(cells)).where("cell IS NOT NULL").groupBy("sample", "measure").agg(F.array_sort(F.collect_list("cell")).alias("c")).select(
        "sample", "measure", F.lit(None).cast("string").alias("gene"), F.concat_ws("\t", F.lit("gene"), F.array_join("c", "\t")).alias("line"))
    return header.unionByName(rows)
