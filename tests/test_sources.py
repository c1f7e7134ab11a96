"""Readers and writers on small files in a fresh temp folder."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from celltally.sinks import files as sinks
from celltally.sources import fastq as fq
from celltally.sources import text as txt


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="celltally-test-")


def write(path, text, gz=False):
    opener = gzip.open if gz else open
    with opener(path, "wt") as f:
        f.write(text)
    return path


def test_whitelist_with_bom(spark, tmp):
    p = os.path.join(tmp, "cbc.txt")
    with open(p, "wb") as f:
        f.write("﻿AGACTC\t1\nAGCTAG\t2\n".encode("utf-8"))
    got = [(r.cbc, r.cell) for r in txt.read_whitelist(spark, p).collect()]
    assert got == [("AGACTC", "1"), ("AGCTAG", "2")]


def test_manifest_columns(spark, tmp):
    ok = write(os.path.join(tmp, "m.csv"), "extra,cbc_file,sample,raw_fq_dir\nx,/c,S1,/fq\n")
    assert [tuple(r) for r in txt.read_manifest(spark, ok).collect()] == [("S1", "/fq", "/c")]
    bad = write(os.path.join(tmp, "bad.csv"), "sample,raw_fq_dir\nS1,/fq\n")
    with pytest.raises(ValueError, match="cbc_file"):
        txt.read_manifest(spark, bad)


def test_fastq_pairs_zip_and_tokens(spark, tmp):
    r1 = "".join(f"@r{i} 1:N\nACGTACGTACGTAAA\n+r{i}\nIIIIIIIIIIIIIII\n" for i in range(5))
    r2 = "".join(f"@r{i} 2:N\nGGGG\n+\nJJJJ\n" for i in range(3))  # shorter: zip stops
    p1 = write(os.path.join(tmp, "S_R1.fq.gz"), r1, gz=True)
    p2 = write(os.path.join(tmp, "S_R2.fq.gz"), r2, gz=True)
    assert fq.sample_pairs(spark, tmp, "S")[0]["r1"] == p1
    df = fq.read_fastq_pairs(spark, fq.sample_pairs(spark, tmp, "S"))
    got = sorted(tuple(r) for r in df.select("rec_no", "r1_name", "r1_plus", "r2_name", "r2_seq").collect())
    assert got == [(i, f"@r{i}", "+", f"@r{i}", "GGGG") for i in range(3)]
    single = fq.read_fastq(spark, [p1], sample="S")
    assert single.count() == 5


def test_no_fastq_files_are_no_reads(spark, tmp):
    assert fq.read_fastq(spark, []).collect() == [] == fq.read_fastq_pairs(spark, []).collect()
    none = spark.createDataFrame([], "sample string, name string, seq string, plus string, qual string")
    sinks.write_fastq(none, os.path.join(tmp, "none"))
    files = [f for folder in fq.listed(spark, os.path.join(tmp, "none")) for f in fq.listed(spark, folder) if "/part-" in f]
    assert fq.read_fastq(spark, files).columns == ["sample", "file", "rec_no", "name", "seq", "plus", "qual"]
    assert fq.read_fastq(spark, files).collect() == []


def test_fastq_chunk_round_trip(spark, tmp):
    recs = spark.createDataFrame([(i, f"@n{i}", "ACGT", "+", "IIII") for i in range(25)],
                                 "rec_no long, name string, seq string, plus string, qual string")
    for r in ("R1", "R2"):
        sinks.write_fastq_chunks(recs, os.path.join(tmp, f"S_{r}"), chunk_size=10)
    items = fq.chunk_pairs(spark, os.path.join(tmp, "S_R1"), os.path.join(tmp, "S_R2"), "S")
    assert len(items) == 3
    df = fq.read_fastq_pairs(spark, items)
    got = sorted((r.rec_no, r.r1_name, r.r2_name) for r in df.collect())
    assert got == [(i, f"@n{i}", f"@n{i}") for i in range(25)]


def test_gtf_comments_and_order(spark, tmp):
    text = (
        "#!header\n"
        'c1\tsrc\tgene\t1\t100\t.\t+\t.\tgene_id "G1"; gene_name "A"; # trailing\n'
        "\n"
        'c1\tsrc\texon\t1\t50\t.\t+\t.\tgene_id "G1";\n'
        '#c1\tsrc\tgene\t5\t9\t.\t+\t.\tgene_id "G9";\n'
    )
    df = txt.read_gtf(spark, write(os.path.join(tmp, "a.gtf"), text))
    got = [(r.feature, r.start, r.end, r.attribute) for r in df.orderBy("line_no").collect()]
    assert got == [("gene", 1, 100, 'gene_id "G1"; gene_name "A"; '), ("exon", 1, 50, 'gene_id "G1";')]


def test_sam_and_contigs(spark, tmp):
    sam = "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:100\n@SQ\tSN:chr2\tLN:50\nq1\t16\tchr1\t11\t255\t5M3N5M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\n"
    p = write(os.path.join(tmp, "a.sam"), sam)
    aln = txt.read_sam(spark, p, sample="S")
    r = aln.first()
    assert (r.qname, r.flag, r.rname, r.pos, r.mapq, r.cigar, r.sample) == ("q1", 16, "chr1", 11, 255, "5M3N5M", "S")
    assert [x.contig for x in txt.read_contigs(spark, p).collect()] == ["chr1", "chr2"]


def test_contigs_read_heads_only(spark, tmp, monkeypatch):
    head = "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:c{i}\tLN:5\n" for i in (3, 1, 2)) + "@PG\tSN:none\n"
    body = "q\t0\tc1\t1\t255\t5M\t*\t0\t0\tACGTA\tIIIII\n@SQ\tSN:late\tLN:1\n"
    os.makedirs(os.path.join(tmp, "sams"))
    write(os.path.join(tmp, "sams", "a.sam"), head + body * 50_000)
    write(os.path.join(tmp, "sams", "b.sam.gz"), head, gz=True)
    write(os.path.join(tmp, "sams", "_SUCCESS"), "")
    write(os.path.join(tmp, "sams", "c.sam"), "")
    for path, times in (("sams", 2), ("sams/a.sam", 1), ("sams/*.gz", 1), ("sams/c.sam", 0)):
        got = sorted((r.place, r.contig) for r in txt.read_contigs(spark, os.path.join(tmp, path), "S").collect())
        assert got == sorted([(1, "c3"), (2, "c1"), (3, "c2")] * times)
    with pytest.raises(FileNotFoundError):
        txt.read_contigs(spark, os.path.join(tmp, "none"))
    from celltally.sources import members
    lines = members.Lines(os.path.join(tmp, "sams", "a.sam"), piece=txt.HEAD_BYTES)
    assert lines.take(5).to_pylist()[1] == b"@SQ\tSN:c3\tLN:5\n" and lines.raw.tell() <= 2 * txt.HEAD_BYTES


def test_order_in_files_is_checked(spark, tmp):
    rows = spark.range(3_000).select(F.when(F.col("id") < 5, None).otherwise(F.floor(F.col("id") / 7)).alias("k"), F.col("id").alias("v"))
    good, bad, inside = (os.path.join(tmp, n) for n in ("good", "bad", "inside"))
    rows.orderBy("k").repartitionByRange(4, "k").sortWithinPartitions("k").write.parquet(good)
    assert txt.ordered(spark.read.parquet(good), "k").where("NOT in_order").count() == 0
    rows.repartitionByRange(4, F.desc("k")).sortWithinPartitions("k").write.parquet(bad)  # each file sorted, the files not
    assert 0 < txt.ordered(spark.read.parquet(bad), "k").where("NOT in_order").count() < 4
    rows.orderBy(F.rand(1)).write.parquet(inside)
    assert txt.ordered(spark.read.parquet(inside), "k").where("NOT in_order").count() > 100


def test_places_over_files(spark, tmp):
    path = os.path.join(tmp, "t")
    spark.range(1_000).select(F.format_string("%05d", "id").alias("value")).repartitionByRange(5, "value").sortWithinPartitions("value").write.text(path)
    got = txt.numbered(spark.read.text(path).withColumn("k", F.col("value").cast("int") % 3), "k").collect()
    assert all(r.place == int(r.value) // 3 + 1 for r in got) and len(got) == 1_000


def test_a_matrix_in_parts(spark, tmp):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        genes = spark.range(2_000).select(F.lit("S").alias("sample"), F.lit("m").alias("measure"), F.format_string("g%05d", "id").alias("gene"))
        lines = genes.withColumn("line", F.concat("gene", F.lit("\t1\t2"))).unionByName(
            spark.createDataFrame([("S", "m", None, "gene\ta\tb")], "sample string, measure string, gene string, line string"))
        sinks.write_matrices(lines.repartition(3), os.path.join(tmp, "m"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = os.path.join(tmp, "m", "sample=S", "measure=m")
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    assert len(parts) > 3
    text = "".join(open(os.path.join(folder, f)).read() for f in parts).splitlines()
    assert text == ["gene\ta\tb"] + [f"g{i:05d}\t1\t2" for i in range(2_000)]
    back = txt.read_matrix(spark, folder)
    assert back.columns == ["gene", "a", "b"] and back.count() == 2_000


def test_feature_and_matrix_sinks(spark, tmp):
    f = spark.createDataFrame([("c", 5, 9, "+", "g2"), ("c", 1, 3, "+", "g1")],
                              "chr string, start long, end long, strand string, gene_fullname string")
    out = os.path.join(tmp, "ex")
    sinks.write_features(f, out)
    back = txt.read_features(spark, out)
    assert [tuple(r) for r in back.collect()] == [("c", 1, 3, "+", "g1"), ("c", 5, 9, "+", "g2")]


def test_tag_name_repeated(spark):
    from celltally.functions.barcodes import parse_tag_name

    cell, umi = parse_tag_name("h")
    df = spark.createDataFrame([("@CBI:1;UMI:AC;CBI:22",), ("UMI:G",), ("CBI:1234;UMI:T",)], "h string")
    got = [tuple(r) for r in df.select(cell.alias("c"), umi.alias("u")).collect()]
    assert got == [("022", "AC"), (None, "G"), ("1234", "T")]


def test_overlap_table_round_trip(spark, tmp):
    rows = [("007", "exon", "c", 5, 9, "n:x:AC:x:001", "+", "g"), ("007", "intron", "c", 1, 2, "m:x:AC:x:001", "-", "h")]
    schema = "sample string, label string, chrom string, start long, end long, qname string, strand string, gene_fullname string"
    df = spark.createDataFrame(rows, schema)
    sinks.write_overlaps(df, os.path.join(tmp, "ov"))
    assert sorted(tuple(r) for r in txt.read_overlap_table(spark, os.path.join(tmp, "ov")).select(*df.columns).collect()) == rows
    for label in ("exon", "intron"):
        part = df.where(f"label = '{label}'").select("chrom", "start", "end", "qname", "strand", "gene_fullname")
        part.write.option("sep", "\t").csv(os.path.join(tmp, label))
    back = txt.read_overlaps(spark, os.path.join(tmp, "intron"), os.path.join(tmp, "exon"), "007")
    assert sorted(tuple(r) for r in back.select(*df.columns).collect()) == rows


def test_sam_fixture_is_many_files(spark):
    """No file of the fixture holds all alignments, and the header is in order in the first one."""
    from celltally.queries import sam_file

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sam_file(spark, "/root/testdata/sf0.01")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("f"), F.col("value").startswith("@").alias("head"))
    heads = [(r.f, r.value.split("\t")[0]) for r in lines.where("head").collect()]
    assert len({f for f, _ in heads}) == 1 and [h for _, h in heads] == ["@HD", *["@SQ"] * 5, "@PG"]
    per_file = lines.where("NOT head").groupBy("f").count().collect()
    assert len(per_file) > 1 and min(r.f for r in per_file) > heads[0][0]
    assert max(r["count"] for r in per_file) < 0.9 * sum(r["count"] for r in per_file)


def test_fixture_rows_move_only_to_be_numbered(spark, sf_small):
    from celltally import fixtures as fx

    names = fx.fx_aligned(spark, sf_small).select("rname", "pos")._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in names and "Window [row_number" not in names
