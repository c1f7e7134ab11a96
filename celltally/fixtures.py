"""Test inputs derived from the driver's TPC-H-ish tables (see FIXTURES.md).

Every view is a Spark plan over the parquet tables, so its size grows with the
scale factor. The DuckDB oracle (``celltally.oracle``) builds the same views
from SQL text; the two are written independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed fixture parameters (shared with the SQL oracle).
BASES = "ACGT"
CBC_MULT, CBC_ADD, CODE_SPACE = 131, 17, 4096
N_CELLS = 48
R2_MISSING_TAIL = 10
# (feature, offset, width) rows emitted for every part; offsets are relative
# to the gene start.
GTF_ROWS = [
    ("gene", 0, 880),
    ("exon", 0, 120),
    ("exon", 60, 130),
    ("exon", 300, 100),
    ("exon", 402, 60),
    ("exon", 620, 1),
    ("exon", 650, 0),
    ("exon", 700, 180),
    ("gene", 5, 990),
]
# Parts with awkward genes: no intron (only the first two exons, which overlap),
# no gene_name, a second gene row of another biotype later in the file.
NO_INTRON, NO_NAME, TWO_GENE_ROWS = 11, 13, 17
# Alignments of every so many orders come twice; the last cell has exon reads only.
REPEAT_ORDERS, EXON_ONLY_CELL = 97, 47
CIGARS = ["50M", "25M200N25M", "10S30M", "20M5D20M2I8M"]  # by l_linenumber % 4
ABSENT_CONTIG = "chr5"
# Largest number of orderkey blocks used to number lineitem rows.
MAX_INDEX_BLOCKS = 65536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dig(x: Column) -> Column:
    """Six base-4 digits of x as letters A,C,G,T; least significant first."""
    return F.concat(*[
        F.substr(F.lit(BASES), F.shiftright(x, 2 * i).bitwiseAND(3).cast("int") + 1, F.lit(1))
        for i in range(6)
    ])


def sample_col(mode: str) -> Column:
    """'one': every row in sample S1; 'two': S0/S1 by supplier parity."""
    if mode == "one":
        return F.lit("S1")
    return F.concat(F.lit("S"), (F.col("l_suppkey") % 2).cast("string"))


def fx_manifest(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample"),
        F.lit("/data/fq").alias("raw_fq_dir"),
        F.lit("/data/cbc.txt").alias("cbc_file"),
    )


def fx_whitelist(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        dig((F.col("s_suppkey") * CBC_MULT + CBC_ADD) % CODE_SPACE).alias("cbc"),
        (F.col("s_suppkey") % N_CELLS + 1).cast("string").alias("cell"),
    )


def fx_whitelist_bad(spark, sf_dir) -> DataFrame:
    w = fx_whitelist(spark, sf_dir)
    return w.select(
        F.when(F.length("cell") == 1, F.substr("cbc", F.lit(1), F.lit(5))).otherwise(F.col("cbc")).alias("cbc"),
        "cell",
    )


def _lineitem_indexed(spark, sf_dir) -> DataFrame:
    """lineitem with rec_no = 0-based position in the fixture sort order.

    Rows are numbered inside blocks of consecutive orderkeys (a window
    partitioned by block, each block bounded in size) and shifted by the row
    count of all earlier blocks (a table with at most MAX_INDEX_BLOCKS rows,
    broadcast). No step sees the whole table in one task.
    """
    # the order's last key, the price, is in no view: rows alike in the others may trade numbers
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    li = table(spark, sf_dir, "lineitem").select(*order)
    max_key = li.agg(F.max("l_orderkey")).first()[0] or 0
    width = max(1024, -(-(int(max_key) + 1) // MAX_INDEX_BLOCKS))
    # only the numbering moves rows: what does not ask for rec_no exchanges none
    li = li.withColumn("blk", F.floor(F.col("l_orderkey") / F.lit(width)).cast("long"))
    counts = li.groupBy("blk").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(
        "blk",
        F.coalesce(
            F.sum("n").over(Window.orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).cast("long").alias("blk_offset"),
    )
    within = F.row_number().over(Window.partitionBy("blk").orderBy(*order)) - 1
    return (
        li.withColumn("pos_in_blk", within)
        .join(F.broadcast(offsets), "blk")
        .select(*order, (F.col("blk_offset") + F.col("pos_in_blk")).cast("long").alias("rec_no"))
    )


def fx_rawid(spark, sf_dir, sample_mode: str = "one") -> DataFrame:
    t = _lineitem_indexed(spark, sf_dir)
    return t.select(
        "*",
        F.concat_ws(":", F.concat(F.lit("R"), F.col("l_orderkey").cast("string")),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    F.col("rec_no").cast("string")).alias("name"),
        ((F.col("l_suppkey") * CBC_MULT + CBC_ADD) % CODE_SPACE).alias("cbc_code"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 64).alias("umi_code"),
        sample_col(sample_mode).alias("sample"),
    )


def _record(df: DataFrame, seq: Column) -> DataFrame:
    return df.select("sample", "rec_no", "name", seq.alias("seq")).select(
        "sample", "rec_no", "name", "seq", F.lit("+").alias("plus"),
        F.repeat(F.lit("I"), F.length("seq")).alias("qual"),
    )


def fx_r1(spark, sf_dir, sample_mode: str = "one") -> DataFrame:
    """Barcode reads: UMI, cell barcode (exact, one N, or last base T), poly-T."""
    r = fx_rawid(spark, sf_dir, sample_mode)
    cbc = dig(F.col("cbc_code"))
    ln = F.col("l_linenumber") % 4
    cbc_read = (
        F.when(ln == 0, F.concat(F.lit("N"), F.substr(cbc, F.lit(2))))
        .when(ln == 1, F.concat(F.substr(cbc, F.lit(1), F.lit(5)), F.lit("T")))
        .otherwise(cbc)
    )
    return _record(r, F.concat(dig(F.col("umi_code")), cbc_read, F.lit("TTTTTTTT")))


def fx_r2(spark, sf_dir, sample_mode: str = "one") -> DataFrame:
    """Biological reads; the last R2_MISSING_TAIL records are absent."""
    r = fx_rawid(spark, sf_dir, sample_mode)
    n = table(spark, sf_dir, "lineitem").count()
    r = r.filter(F.col("rec_no") < F.lit(n - R2_MISSING_TAIL))
    seq = F.concat(dig(F.col("l_partkey")), dig(F.col("l_orderkey")), dig(F.col("l_suppkey")), F.lit("ACGTAC"))
    return _record(r, seq)


def fx_r2_bad(spark, sf_dir, sample_mode: str = "one") -> DataFrame:
    r = fx_r2(spark, sf_dir, sample_mode)
    return r.select(
        "sample", "rec_no",
        F.when(F.col("rec_no") % 500 == 0, F.concat("name", F.lit("x"))).otherwise(F.col("name")).alias("name"),
        "seq",
        F.when(F.col("rec_no") % 700 == 0, F.lit("-")).otherwise(F.col("plus")).alias("plus"),
        F.when(F.col("rec_no") % 333 == 0, F.substr("qual", F.lit(2))).otherwise(F.col("qual")).alias("qual"),
    )


def fx_gtf(spark, sf_dir) -> DataFrame:
    """Up to nine annotation rows per part (a gene or two, seven exons); a
    generator, not a join, multiplies the rows."""
    # part is one small file; spread it so the eight-fold rows parse in parallel
    p = table(spark, sf_dir, "part")
    p = p.repartition(max(1, spark.sparkContext.defaultParallelism), "p_partkey")
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(o).cast("long").alias("o"), F.lit(w).cast("long").alias("w"))
        for f, o, w in GTF_ROWS
    ])
    base = F.lit(1000) * F.floor(F.col("p_partkey") / 10).cast("long") + 1 + (F.col("p_size") % 3) * 20
    biotype = (
        F.when((F.col("feature") == "gene") & (F.col("o") == 5), "second")
        .when(F.col("p_size") % 5 == 0, "lncRNA")
        .when(F.col("p_size") % 5 == 1, "IG_C_gene")
        .otherwise("protein_coding")
    )
    attribute = F.concat(
        F.lit('gene_id "G'), F.col("p_partkey").cast("string"),
        F.when(F.col("p_partkey") % NO_NAME == 0, "").otherwise(F.concat(F.lit('"; gene_name "'), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))),
        F.lit('"; gene_biotype "'), biotype,
        F.lit('"; note "two words"; tag "basic"; tag "CCDS";'),
    )
    return (
        p.select("*", F.inline(rows))
        .filter((F.col("p_partkey") % NO_INTRON != 0) | (F.col("feature") == "gene") | (F.col("o") <= 60))
        .filter((F.col("p_partkey") % TWO_GENE_ROWS == 0) | (F.col("feature") != "gene") | (F.col("o") == 0))
        .select(
            F.concat(F.lit("chr"), (F.col("p_partkey") % 5 + 1).cast("string")).alias("seqname"),
            F.lit("fx").alias("source"),
            "feature",
            (base + F.col("o")).cast("long").alias("start_"),
            (base + F.col("o") + F.col("w")).cast("long").alias("end_"),
            F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"),
            attribute.alias("attribute"),
        )
    )


def fx_gtf_text(spark, sf_dir) -> DataFrame:
    """GTF lines: some gene lines commented out, some lines with a trailing
    ``# note`` comment."""
    g = fx_gtf(spark, sf_dir)
    tab = F.lit("\t")
    return g.select(
        F.concat(
            F.when((F.col("feature") == "gene") & (F.col("start_") % 3000 == 1), F.lit("#")).otherwise(F.lit("")),
            "seqname", tab, "source", tab, "feature", tab, F.col("start_").cast("string"), tab,
            F.col("end_").cast("string"), tab, F.lit("."), tab, "strand", tab, F.lit("."), tab, "attribute",
            F.when(F.col("start_") % 2 == 1, F.lit(" # note")).otherwise(F.lit("")),
        ).alias("value")
    )


def fx_aligned(spark, sf_dir, sample_mode: str = "one") -> DataFrame:
    """Aligned reads (one row per alignment) named like barcoded reads."""
    r = fx_rawid(spark, sf_dir, sample_mode)
    cbc = dig(F.col("cbc_code"))
    umi = dig(F.col("umi_code"))
    ln = F.col("l_linenumber") % 4
    cigar = F.when(ln == 0, CIGARS[0]).when(ln == 1, CIGARS[1]).when(ln == 2, CIGARS[2]).otherwise(CIGARS[3])
    cell = F.lpad((F.col("l_suppkey") % N_CELLS + 1).cast("string"), 3, "0")
    offset = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 1000
    unmapped = (F.col("l_suppkey") % N_CELLS == EXON_ONLY_CELL) & ((offset >= 60) | (ln != 0))
    r = r.withColumn("copy", F.explode(F.when(F.col("l_orderkey") % REPEAT_ORDERS == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return r.select(
        "sample",
        F.concat(F.lit("chr"), (F.col("l_partkey") % 5 + 1).cast("string")).alias("rname"),
        (F.lit(1000) * F.floor(F.col("l_partkey") / 10).cast("long") + 1
         + (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 1000).cast("long").alias("pos"),
        F.when(F.col("l_quantity") > 5, F.lit(255)).otherwise(F.lit(3)).cast("int").alias("mapq"),
        F.when(unmapped, F.lit(4)).when((F.col("l_orderkey") + F.col("l_linenumber")) % 2 == 0, F.lit(0))
        .otherwise(F.lit(16)).cast("int").alias("flag"),
        cigar.alias("cigar"),
        F.concat_ws(":", "name", F.concat(umi, cbc), umi, cbc, cell).alias("qname"),
    )


def fx_contigs(spark, sf_dir, sample_mode: str = "one") -> DataFrame:
    a = fx_aligned(spark, sf_dir, sample_mode)
    return a.select(F.col("rname").alias("contig")).filter(F.col("contig") != ABSENT_CONTIG).distinct()


def fx_tag_names(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(
            F.when(F.col("s_suppkey") % 2 == 0, F.lit("@")).otherwise(F.lit("")),
            F.lit("CBI:"), (F.col("s_suppkey") % 1500).cast("string"),
            F.lit(";UMI:"), dig(F.col("s_suppkey") * 29),
        ).alias("h")
    )
