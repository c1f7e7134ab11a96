"""Gene, exon and intron interval tables from GTF rows.

Coordinates are taken as written in the GTF: an exon covers the half-open
range [start, end). Exons of a gene id are merged where they overlap or
touch; an intron between merged exons [s1, e1) and [s2, e2) is
[e1 + 1, s2 - 1). Empty rows (start >= end) are dropped and identical
(chr, start, end, strand) rows of different genes are pooled into one row
named by the sorted names joined with ``-``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.functions.gtf import (
    attribute_from_text,
    attribute_value,
    biotype_camel,
    clean_name,
    gene_fullname,
    parse_attributes,
)
from celltally.operators.intervals import merge_intervals

GENE_KEYS = ["gene_id", "gene_name", "gene_biotype"]
FEATURE_COLS = ["chr", "start", "end", "strand", "gene_fullname"]


def with_attributes(gtf: DataFrame) -> DataFrame:
    """Add ``attrs`` (map) parsed from the ``attribute`` text; keep a
    file-order column ``line_no`` (added when the input has none)."""
    df = gtf if "line_no" in gtf.columns else gtf.withColumn("line_no", F.monotonically_increasing_id())
    return df.withColumn("attrs", parse_attributes("attribute"))


def attribute_keys(gtf: DataFrame) -> DataFrame:
    """Distinct attribute keys over all rows (column ``key``)."""
    df = gtf if "attrs" in gtf.columns else with_attributes(gtf)
    return df.select(F.explode(F.map_keys("attrs")).alias("key")).distinct()


def widen(gtf: DataFrame, keys: list[str]) -> DataFrame:
    """One column per attribute key, ``-`` where a row lacks the key.

    Reads the keys from a parsed ``attrs`` map when present, else straight
    from the attribute text (one regular expression per key)."""
    if "attrs" in gtf.columns:
        return gtf.select("*", *[attribute_value("attrs", k).alias(k) for k in keys])
    df = gtf if "line_no" in gtf.columns else gtf.withColumn("line_no", F.monotonically_increasing_id())
    return df.select("*", *[attribute_from_text("attribute", k).alias(k) for k in keys])


def widen_all(gtf: DataFrame) -> DataFrame:
    """One column per attribute key that any row carries (by code point), ``-``
    where a row lacks it, in place of the ``attribute`` text.

    Two passes: the first gathers the distinct keys, one per column of the
    result, which is all that reaches the driver; the second parses each text
    once. A key named like a GTF column replaces it, a key ``attribute`` gives
    no column. Keys that differ in case alone need ``spark.sql.caseSensitive``
    to be told apart by name. A table without attributes only loses the text.
    """
    keys = sorted(r.key for r in attribute_keys(gtf).collect() if r.key != "attribute")
    base = [c for c in gtf.columns if c not in ("attribute", "attrs", *keys)]
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    attrs = F.col("attrs") if "attrs" in gtf.columns else parse_attributes("attribute")
    parsed = gtf.select(F.struct(*[quoted(c).alias(c) for c in base]).alias("row"), attrs.alias("attrs"))
    return parsed.select(*[F.col("row").getField(c).alias(c) for c in base], *[attribute_value("attrs", k).alias(k) for k in keys])


def gene_attributes(gtf: DataFrame) -> DataFrame:
    """GTF rows with gene_id, gene_name (``-`` -> ``.``), gene_biotype
    (camel-cased when it holds ``_``) and gene_fullname."""
    w = widen(gtf, GENE_KEYS)
    w = w.withColumn("gene_name", clean_name("gene_name")).withColumn("gene_biotype", biotype_camel("gene_biotype"))
    return w.withColumn("gene_fullname", gene_fullname("gene_id", "gene_name", "gene_biotype"))


def gene_table(gtf: DataFrame) -> DataFrame:
    """Rows of feature ``gene``: seqname, start, end, strand, gene_fullname."""
    g = gene_attributes(gtf).filter(F.col("feature") == "gene")
    return g.select("seqname", "start", "end", "strand", "gene_fullname")


def first_gene_rows(genes: DataFrame) -> DataFrame:
    """Per gene_id the first ``gene`` row in file order: chr, strand, name."""
    return genes.groupBy("gene_id").agg(
        F.min_by(F.struct(F.col("seqname").alias("chr"), "strand", "gene_fullname"), F.col("line_no")).alias("g")
    ).select("gene_id", "g.chr", "g.strand", "g.gene_fullname")


def merged_exons(gtf_attr: DataFrame) -> DataFrame:
    """Merged exon islands per gene_id (by position only, any contig)."""
    ex = gtf_attr.filter((F.col("feature") == "exon") & (F.col("start") < F.col("end"))).select("gene_id", "start", "end")
    return merge_intervals(ex, ["gene_id"])


def gaps_between(islands: DataFrame) -> DataFrame:
    """Introns [e1 + 1, s2 - 1) between consecutive islands of a gene."""
    w = Window.partitionBy("gene_id").orderBy("start")
    prev_end = F.lag("end").over(w)
    return islands.select("gene_id", (prev_end + 1).alias("start"), (F.col("start") - 1).alias("end")).filter(
        F.col("start").isNotNull()
    )


def pool_features(df: DataFrame, *keys: str, counted: bool = False) -> DataFrame:
    """Identical (chr, start, end, strand) rows (of equal ``keys``) -> one row;
    names sorted and joined with ``-`` (repeated names kept); ``counted`` adds
    how many there are."""
    n = [F.count(F.lit(1)).alias("n_genes")] if counted else []
    names = F.array_join(F.array_sort(F.collect_list("gene_fullname")), "-").alias("gene_fullname")
    return df.groupBy(*keys, "chr", "start", "end", "strand").agg(names, *n)


def exon_intron_tables(gtf: DataFrame, pooled: bool = True) -> tuple[DataFrame, DataFrame]:
    """(exons, introns) feature tables: chr, start, end, strand, gene_fullname.

    Gene facts (contig, strand, full name) come from the first ``gene`` row
    of each gene id; gene ids without a gene row or without a non-empty exon
    are left out (see :func:`incomplete_genes`).
    """
    attr = gene_attributes(gtf)
    first = first_gene_rows(attr.filter(F.col("feature") == "gene"))
    islands = merged_exons(attr)
    introns = gaps_between(islands)

    def finish(df):
        out = df.join(first, "gene_id").select(*FEATURE_COLS).filter(F.col("start") < F.col("end"))
        return pool_features(out) if pooled else out

    return finish(islands), finish(introns)


def incomplete_genes(gtf: DataFrame) -> DataFrame:
    """Gene ids that give no feature rows: no ``gene`` row, or no exon with
    start < end. Columns: gene_id, has_gene, has_exon."""
    attr = gene_attributes(gtf)
    per = attr.groupBy("gene_id").agg(
        F.count_if(F.col("feature") == "gene").alias("n_gene"),
        F.count_if((F.col("feature") == "exon") & (F.col("start") < F.col("end"))).alias("n_exon"),
    )
    return per.filter((F.col("n_gene") == 0) | (F.col("n_exon") == 0)).select(
        "gene_id", (F.col("n_gene") > 0).alias("has_gene"), (F.col("n_exon") > 0).alias("has_exon")
    )
