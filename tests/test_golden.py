"""Hand-worked cases of FIXTURES.md part B."""

import math

import pytest
from pyspark.sql import functions as F

from celltally.functions.counting import umi_to_transcripts
from celltally.functions.gtf import biotype_camel, clean_name, parse_attributes
from celltally.operators import annotation as ann
from celltally.operators import barcodes as bc
from celltally.operators import counts as cnt
from celltally.operators import intervals as iv
from celltally.plans import steps


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------------------------------------------------------------- B1
@pytest.mark.parametrize("hd,expected", [(0, 12), (1, 40)])
def test_whitelist_expansion(spark, hd, expected):
    wl = spark.createDataFrame([("AAAAAA", "1"), ("AAAAAT", "2")], "cbc string, cell string")
    d = bc.barcode_dictionary(wl, hd)
    got = {r.seq: r.cell for r in d.collect()}
    assert len(got) == expected
    assert "AAAAAN" not in got
    if hd == 0:
        assert got["AAAAAA"] == "1" and got["AAAAAT"] == "2"
    else:  # both exact barcodes are within distance 1 of each other: dropped
        assert "AAAAAA" not in got and "AAAAAT" not in got
        assert got["CAAAAA"] == "1" and got["CAAAAT"] == "2"


def test_hd2_matches_bruteforce(spark):
    wl_rows = [("ACGTAC", "1"), ("ACGTTT", "2"), ("GGGCCC", "3"), ("TTTTTT", "4")]
    wl = spark.createDataFrame(wl_rows, "cbc string, cell string")
    d = {r.seq: r.cell for r in bc.barcode_dictionary(wl, 2).collect()}
    import itertools
    letters = "NCTGA"
    brute = {}
    for s in map("".join, itertools.product("ACGTN", repeat=6)):
        cells = {c for b, c in wl_rows if sum(x != y for x, y in zip(s, b)) <= 2}
        if len(cells) == 1:
            brute[s] = cells.pop()
    assert {k: v for k, v in d.items() if set(k) <= set(letters)} == brute


# ---------------------------------------------------------------- B2
def gtf_df(spark, rows_):
    return spark.createDataFrame(
        [(c, "t", f, s, e, ".", st, ".", a, i) for i, (c, f, s, e, st, a) in enumerate(rows_)],
        "seqname string, source string, feature string, start long, end long, score string, strand string, "
        "frame string, attribute string, line_no long",
    )


def test_annotation_golden(spark):
    ga = 'gene_id "GA"; gene_name "H2-K1"; gene_biotype "protein_coding"; note "two words"; tag "a"; tag "b";'
    rows_ = [("chr1", "gene", 100, 400, "+", ga)] + [
        ("chr1", "exon", s, e, "+", ga) for s, e in [(101, 150), (141, 160), (160, 180), (250, 250), (300, 302), (304, 400)]
    ]
    g = gtf_df(spark, rows_)
    a = steps.annotate(g)
    name = "GA_H2.K1_ProteinCoding"
    assert rows(a.exons, "chr", "start", "end", "strand", "gene_fullname") == [
        ("chr1", 101, 180, "+", name), ("chr1", 300, 302, "+", name), ("chr1", 304, 400, "+", name)]
    assert rows(a.introns, "start", "end") == [(181, 299)]
    m = g.select(parse_attributes("attribute").alias("m")).first().m
    assert m == {"gene_id": "GA", "gene_name": "H2-K1", "gene_biotype": "protein_coding", "tag": "b"}


def test_pooling_and_text(spark):
    def attr(gid, name, bt):
        return f'gene_id "{gid}"; gene_name "{name}"; gene_biotype "{bt}";'
    rows_ = []
    for gid in ("B", "A"):
        a = attr(gid, "x", "y")
        rows_ += [("chr2", "gene", 10, 90, "-", a), ("chr2", "exon", 10, 20, "-", a), ("chr2", "exon", 40, 50, "-", a)]
    a = steps.annotate(gtf_df(spark, rows_))
    assert rows(a.exons, "start", "end", "gene_fullname") == [(10, 20, "A_x_y-B_x_y"), (40, 50, "A_x_y-B_x_y")]
    assert rows(a.introns, "start", "end", "gene_fullname") == [(21, 39, "A_x_y-B_x_y")]
    df = spark.createDataFrame([("protein_coding", "H2-K1"), ("IG_C_gene", "-"), ("lncRNA", "Abc")], "b string, n string")
    got = [(r.b, r.n) for r in df.select(biotype_camel("b").alias("b"), clean_name("n").alias("n")).collect()]
    assert got == [("ProteinCoding", "H2.K1"), ("IgCGene", "."), ("lncRNA", "Abc")]


def test_gene_without_gene_row_is_reported(spark):
    a = 'gene_id "GX"; gene_name "x"; gene_biotype "y";'
    g = gtf_df(spark, [("chr1", "exon", 1, 10, "+", a)])
    exons, introns = ann.exon_intron_tables(g)
    assert exons.count() == 0 and introns.count() == 0
    assert rows(ann.incomplete_genes(g), "gene_id", "has_gene", "has_exon") == [("GX", False, True)]


# ---------------------------------------------------------------- B3 / B4
def b3_inputs(spark):
    exons = spark.createDataFrame([("c", 101, 180, "+", "GA"), ("c", 205, 230, "-", "GB")],
                                  "chr string, start long, end long, strand string, gene_fullname string")
    introns = spark.createDataFrame([("c", 181, 299, "+", "GA")],
                                    "chr string, start long, end long, strand string, gene_fullname string")
    blocks = spark.createDataFrame(
        [("S", "c", 110, 160, "r1:AAA:CCC:AAA:001", 255, "+"), ("S", "c", 170, 220, "r2:AAA:CCC:AAA:001", 255, "+"),
         ("S", "c", 200, 250, "r3:AAA:GGG:AAA:001", 255, "+"), ("S", "c", 205, 225, "r4:AAA:TTT:AAA:001", 255, "-")],
        "sample string, chrom string, start long, end long, qname string, mapq int, strand string")
    return blocks, iv.label_features(exons=exons, introns=introns)


@pytest.mark.parametrize("bin_size", [1, 7, 50, 10_000])
def test_overlap_and_anti_join_golden(spark, bin_size):
    blocks, features = b3_inputs(spark)
    ov = iv.overlap_join(blocks, features, bin_size)
    cols = ("label", "start", "end", "qname", "gene_fullname")
    short = lambda rs: sorted((l, s, e, q.split(":")[0], g) for l, s, e, q, g in rs)
    assert short(rows(ov, *cols)) == sorted([
        ("intron", 181, 220, "r2", "GA"), ("intron", 200, 250, "r3", "GA"),
        ("exon", 110, 160, "r1", "GA"), ("exon", 170, 180, "r2", "GA"), ("exon", 205, 225, "r4", "GB")])
    clean = iv.clean_overlaps(ov, bin_size)["clean"]
    assert short(rows(clean, *cols)) == sorted([("exon", 110, 160, "r1", "GA"), ("exon", 170, 180, "r2", "GA")])


def test_counts_golden(spark):
    rows_ = [("S", "exon", "c", 110, 160, "r1:AAAAAA:ACGTAC:AAAAAA:001", "+", "GA"),
             ("S", "exon", "c", 170, 180, "r2:AAAAAA:ACGTAC:AAAAAA:001", "+", "GA")]
    schema = "sample string, label string, chrom string, start long, end long, qname string, strand string, gene_fullname string"
    c = cnt.gene_cell_counts(cnt.molecules(spark.createDataFrame(rows_, schema))).first()
    assert (c.reads_unspliced, c.reads_spliced, c.reads_total) == (0, 2, 2)
    assert (c.umis_unspliced, c.umis_spliced, c.umis_total) == (0, 1, 1)
    assert c.gene == "GA__c" and c.cell == "001"
    rows_[0] = ("S", "intron") + rows_[0][2:]
    c = cnt.gene_cell_counts(cnt.molecules(spark.createDataFrame(rows_, schema))).first()
    assert (c.reads_unspliced, c.reads_spliced, c.reads_total) == (1, 1, 2)
    assert (c.umis_unspliced, c.umis_spliced, c.umis_total) == (1, 0, 1)


def test_transcript_estimate(spark):
    df = spark.createDataFrame([(0,), (1,), (10,), (4096,), (5000,)], "x long")
    got = [r.t for r in df.select(umi_to_transcripts("x", 6).alias("t")).collect()]
    assert got[0] == 0 and got[1] == pytest.approx(1.0)
    assert round(got[2], 9) == pytest.approx(10.011004690508, abs=1e-9)
    assert round(got[3], 6) == pytest.approx(62356.12277, abs=1e-5) and got[3] == got[4]
    k = 4096.0
    assert got[2] == pytest.approx(math.log(1 - 10 / k) / math.log(1 - 1 / k), rel=1e-15)


def test_duplicate_rows_kept_once(spark):
    blocks, features = b3_inputs(spark)
    doubled = blocks.unionByName(blocks.filter(F.col("start") == 110))
    ov = iv.clean_overlaps(iv.overlap_join(doubled, features, 50), 50)["overlaps"]
    assert ov.filter(F.col("start") == 110).count() == 1


# ---------------------------------------------------------------- B5
def test_alignment_blocks(spark):
    aln = spark.createDataFrame(
        [("S", "c", 101, 255, 0, "50M", "a"), ("S", "c", 101, 255, 16, "25M200N25M", "b"),
         ("S", "c", 101, 255, 0, "10S30M", "c"), ("S", "c", 101, 255, 0, "20M5D20M2I8M", "d"),
         ("S", "c", 101, 255, 4, "50M", "unmapped")],
        "sample string, rname string, pos long, mapq int, flag int, cigar string, qname string")
    got = rows(iv.align_blocks(aln), "qname", "start", "end", "strand")
    assert got == [("a", 100, 150, "+"), ("b", 100, 125, "-"), ("b", 325, 350, "-"), ("c", 100, 130, "+"),
                   ("d", 100, 153, "+")]
