"""End-to-end run from files: manifest, whitelists, FASTQ pairs, GTF, SAM."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from celltally.plans import run as R
from celltally.plans import steps
from celltally.sinks import files as sinks
from celltally.sources import text as txt

PARAMS = steps.BarcodeParams(len_cbc=6, len_umi=6, umi_first=True)
# UMI first (6), then cell barcode (6); the third read has an unknown barcode
READS = {"S1": [("GGGGGG", "AAAAAA"), ("TTTTTT", "CCCCCC"), ("GGGGGG", "GTGTGT")], "S3": [("CCCCCC", "AAAAAA")]}


def gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def fastq(reads, first=0, name="q", qual=0):
    r1 = r2 = ""
    for i, (umi, cbc) in enumerate(reads, first):
        s = umi + cbc + "TTTT"
        r1 += f"@q{i} 1:N\n{s}\n+\n{'I' * (len(s) - qual)}\n"
        r2 += f"@{name}{i} 2:N\nACGTACGTAC\n+\nIIIIIIIIII\n"
    return r1, r2


@pytest.fixture()
def case(spark):
    """A folder with two samples, and their inputs."""
    d = tempfile.mkdtemp(prefix="celltally-run-")
    fq = os.path.join(d, "fq")
    os.makedirs(fq)
    for name, cells in (("a", "AAAAAA\t1\nCCCCCC\t2\n"), ("b", "AAAAAA\t7\n")):
        with open(f"{d}/cbc_{name}.txt", "w") as f:
            f.write(cells)
    for s, reads in READS.items():
        r1, r2 = fastq(reads)
        gz(f"{fq}/{s}_R1.fq.gz", r1 + ("@tail\nAC\n+\nII\n" if s == "S3" else ""))
        gz(f"{fq}/{s}_R2.fq.gz", r2)
    with open(f"{d}/manifest.csv", "w") as f:
        f.write(f"sample,raw_fq_dir,cbc_file\nS1,file://{fq},file://{d}/cbc_a.txt\nS3,file://{fq},file://{d}/cbc_b.txt\n")
    with open(f"{d}/a.gtf", "w") as f:
        a = 'gene_id "G1"; gene_name "g"; gene_biotype "protein_coding";'
        f.write(f"c1\tt\tgene\t100\t400\t.\t+\t.\t{a}\nc1\tt\texon\t100\t200\t.\t+\t.\t{a}\nc1\tt\texon\t300\t400\t.\t+\t.\t{a}\n")
    sam = {"S1": "q0:GGGGGGAAAAAA:GGGGGG:AAAAAA:001\t0\tc1\t121\t255\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\n"
                 "q1:TTTTTTCCCCCC:TTTTTT:CCCCCC:002\t0\tc1\t231\t255\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\n",
           "S3": "q0:CCCCCCAAAAAA:CCCCCC:AAAAAA:007\t0\tc1\t121\t255\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\n"}
    aln = None
    for s, rows in sam.items():
        with open(f"{d}/{s}.sam", "w") as f:
            f.write("@SQ\tSN:c1\tLN:1000\n" + rows)
        one = txt.read_sam(spark, f"{d}/{s}.sam", sample=s)
        aln = one if aln is None else aln.unionByName(one)
    return d, aln


def start(spark, d, aln, **kw):
    return R.run(spark, f"file://{d}/manifest.csv", kw.pop("gtf", f"file://{d}/a.gtf"), aln, kw.pop("out", f"file://{d}/out"), PARAMS, **kw)


def counted(res):
    return sorted((r.sample, r.cell, r.gene, r.umis_spliced, r.umis_unspliced) for r in res.counts.collect())


WANT = [("S1", "001", "G1_g_ProteinCoding__c1", 1, 0), ("S1", "002", "G1_g_ProteinCoding__c1", 0, 1), ("S3", "007", "G1_g_ProteinCoding__c1", 1, 0)]


def test_run_of_two_samples(spark, case):
    d, aln = case
    res = start(spark, d, aln)
    assert counted(res) == WANT
    stats = {r.sample: r for r in spark.read.json(f"{d}/out/read_stats").collect()}
    assert (stats["S1"].n_reads, stats["S1"].n_matched, stats["S1"].n_unpaired) == (3, 2, 0)
    assert (stats["S3"].n_reads, stats["S3"].n_matched, stats["S3"].n_unpaired) == (1, 1, 1)
    assert stats["S1"].parameters.len_cbc == 6 and stats["S1"].parameters.bc_read == "R1"
    names = {s: sorted(r.value for r in spark.read.text(f"{d}/out/barcoded/sample={s}").filter(F.col("value").startswith("@")).collect()) for s in READS}
    assert names == {"S1": ["@q0:GGGGGGAAAAAA:GGGGGG:AAAAAA:001", "@q1:TTTTTTCCCCCC:TTTTTT:CCCCCC:002"],
                     "S3": ["@q0:CCCCCCAAAAAA:CCCCCC:AAAAAA:007"]}
    m = spark.read.option("header", True).option("sep", "\t").csv(f"{d}/out/matrices/sample=S1/measure=umis_total")
    assert m.columns == ["gene", "001", "002"] and [tuple(r) for r in m.collect()] == [("G1_g_ProteinCoding__c1", "1", "1")]
    assert len([x for x in os.listdir(f"{d}/out/matrices/sample=S1") if x.startswith("measure=")]) == 9
    # the same from the interval tables of that run, and from its overlap rows
    again = start(spark, d, aln, gtf=None, out=f"{d}/out2", exons=f"{d}/out/annotation/exons", introns=f"{d}/out/annotation/introns")
    assert counted(again) == WANT
    third = R.count_overlaps(spark, txt.read_overlap_table(spark, f"{d}/out/overlaps"), f"{d}/out3")
    assert sorted((r.sample, r.cell, r.gene, r.umis_spliced, r.umis_unspliced) for r in third.collect()) == WANT


def test_a_run_needs_an_annotation(spark, case):
    with pytest.raises(ValueError, match="exon and an intron table"):
        start(spark, *case, gtf=None)


def test_missing_sample_files(spark, case):
    d, aln = case
    os.rename(f"{d}/fq/S3_R2.fq.gz", f"{d}/elsewhere.gz")
    with pytest.raises(FileNotFoundError, match="sample S3.*S3_R2"):
        start(spark, d, aln)


@pytest.mark.parametrize("kw, what", [({"name": "x"}, "names differ"), ({"qual": 1}, "not as long")])
def test_bad_pairs(spark, case, kw, what):
    d, aln = case
    r1, r2 = fastq(READS["S1"], **kw)
    gz(f"{d}/fq/S1_R1.fq.gz", r1)
    gz(f"{d}/fq/S1_R2.fq.gz", r2)
    with pytest.raises(Exception, match=f"sample S1, record 0.*{what}"):
        start(spark, d, aln)


def test_bad_plus_line(spark, case):
    d, aln = case
    r1, r2 = fastq(READS["S1"])
    gz(f"{d}/fq/S1_R1.fq.gz", r1.replace("\n+\n", "\n-\n"))
    gz(f"{d}/fq/S1_R2.fq.gz", r2)
    with pytest.raises(Exception, match="plus lines differ"):
        start(spark, d, aln)


def test_bad_whitelist(spark, case):
    d, aln = case
    with open(f"{d}/cbc_b.txt", "w") as f:
        f.write("AAAA\t7\n")
    with pytest.raises(ValueError, match="6 bases long.*S3.*AAAA"):
        start(spark, d, aln)


def test_missing_chunk(spark, case):
    d, aln = case
    for r in ("R1", "R2"):
        os.rename(f"{d}/fq/S1_{r}.fq.gz", f"{d}/whole_{r}.gz")
        recs = spark.createDataFrame([(i, f"@n{i}", "ACGTACGTACGTAA", "+", "I" * 14) for i in range(25)],
                                     "rec_no long, name string, seq string, plus string, qual string")
        sinks.write_fastq_chunks(recs, f"{d}/fq/S1_{r}", chunk_size=10)
    pairs = R.read_pairs(spark, txt.read_manifest(spark, f"{d}/manifest.csv")).where("sample = 'S1'")
    assert sorted(r.rec_no for r in pairs.collect()) == list(range(25))
    os.rename(f"{d}/fq/S1_R2/chunk=10", f"{d}/chunk10")
    with pytest.raises(FileNotFoundError, match="chunk 10 is missing in .*S1_R2"):
        start(spark, d, aln)


def test_no_shared_folder_on_a_cluster():
    from celltally import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Spark:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Spark())


def test_a_record_beyond_the_shorter_file_is_not_tested(spark, case):
    d, aln = case
    r1, r2 = fastq(READS["S3"])
    gz(f"{d}/fq/S3_R1.fq.gz", r1 + "@tail\nACGT\n-\nII\n")
    gz(f"{d}/fq/S3_R2.fq.gz", r2)
    assert counted(start(spark, d, aln)) == WANT
