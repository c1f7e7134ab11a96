"""Properties on the fixture tables (sf0.001)."""

import pytest
import theta
from pyspark.sql import functions as F

from celltally import fixtures as fx
from celltally import queries as q
from celltally.operators import intervals as iv

COLS = iv.OVERLAP_COLS


def as_set(df):
    return {tuple(r[c] for c in COLS) for r in df.select(*COLS).collect()}


@pytest.fixture(scope="module")
def inputs(spark, sf_small):
    a = q.annotation(spark, sf_small)
    feats = iv.label_features(exons=a.exons, introns=a.introns).cache()
    blocks = iv.align_blocks(fx.fx_aligned(spark, sf_small, "two")).filter(F.col("mapq") == 255).cache()
    return blocks, feats


def test_binned_join_equals_theta(inputs):
    blocks, feats = inputs
    want = as_set(theta.overlap_join(blocks, feats))
    assert want
    for b in (37, 300, 10_000):
        assert as_set(iv.overlap_join(blocks, feats, b)) == want
    # the shuffle form (no broadcast) gives the same rows
    assert as_set(iv.overlap_join(blocks, feats, 300, broadcast_max_bytes=None)) == want


def test_binned_anti_join_equals_theta(inputs):
    blocks, feats = inputs
    ov = iv.overlap_join(blocks, feats, 300)
    want = as_set(theta.clean_overlaps(ov))
    for b in (50, 300, 10_000):
        assert as_set(iv.clean_overlaps(ov, b)["clean"]) == want


def test_count_identities(spark, sf_small):
    c = q.counted(spark, sf_small).counts
    bad = c.filter(
        (F.col("reads_unspliced") + F.col("reads_spliced") != F.col("reads_total"))
        | (F.col("umis_unspliced") + F.col("umis_spliced") != F.col("umis_total"))
        | (F.col("umis_total") > F.col("reads_total"))
    )
    assert c.count() > 0 and bad.count() == 0


def test_read_stats_bounds(spark, sf_small):
    s = q.read_stats(spark, sf_small).collect()
    assert len(s) == 2
    for r in s:
        assert 0 < r.n_matched <= r.n_reads and r.frac == pytest.approx(r.n_matched / r.n_reads)


def test_rec_no_is_dense(spark, sf_small):
    r = fx.fx_rawid(spark, sf_small)
    n = fx.table(spark, sf_small, "lineitem").count()
    agg = r.agg(F.min("rec_no"), F.max("rec_no"), F.count_distinct("rec_no")).first()
    assert tuple(agg) == (0, n - 1, n)


def test_hot_interval_and_hot_molecule(spark):
    """One locus holding most rows (same block, same UMI) gives the same
    answer as the plain theta forms."""
    from celltally.operators import counts as cnt

    exons = spark.createDataFrame([("c", 100, 200, "+", "GA"), ("c", 300, 400, "+", "GA")],
                                  "chr string, start long, end long, strand string, gene_fullname string")
    introns = spark.createDataFrame([("c", 201, 299, "+", "GA")],
                                    "chr string, start long, end long, strand string, gene_fullname string")
    feats = iv.label_features(exons=exons, introns=introns)
    rows = [("S", "c", 120, 170, f"r{i}:x:AAAAAA:x:001", 255, "+") for i in range(3000)]  # hot exon block
    rows += [("S", "c", 150, 250, f"s{i}:x:CCCCCC:x:002", 255, "+") for i in range(50)]  # exon + intron, blocked
    rows += [("S", "c", 260, 280, f"t{i}:x:GGGG{i % 7:02d}:x:001", 255, "+") for i in range(200)]  # intron only
    blocks = spark.createDataFrame(rows, "sample string, chrom string, start long, end long, qname string, mapq int, strand string")
    ov = iv.overlap_join(blocks, feats, 64)
    assert as_set(ov) == as_set(theta.overlap_join(blocks, feats))
    clean = iv.clean_overlaps(ov, 16)["clean"]
    assert as_set(clean) == as_set(theta.clean_overlaps(ov))
    got = {(r.cell, r.umis_spliced, r.umis_unspliced, r.reads_spliced, r.reads_unspliced)
           for r in cnt.gene_cell_counts(cnt.molecules(clean)).collect()}
    # s-reads: their exon part [150,200) meets the intron part [201,250)? no
    # (200 <= 201); it meets the t-reads' intron interval [260,280)? no; so kept
    assert ("001", 1, 7, 3000, 200) in got


def test_numbers_of_rows_that_differ_in_price_only(spark, tmp_path):
    """The price orders rows that are alike in all that the views show: it need not be exchanged."""
    from pyspark.sql.window import Window

    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    li = spark.range(4_000).select(*[(F.xxhash64("id", F.lit(k)) % 3 + 3).alias(k) for k in keys[1:]], F.col("id").alias("l_extendedprice"), (F.pmod(F.xxhash64("id"), F.lit(9)) * 700).alias("l_orderkey"))
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    li = fx.table(spark, str(tmp_path), "lineitem")
    want = li.select(*keys, (F.row_number().over(Window.orderBy(*keys, "l_extendedprice")) - 1).alias("rec_no"))
    got = fx.fx_rawid(spark, str(tmp_path)).select(*keys, "rec_no")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "l_extendedprice" not in got._jdf.queryExecution().executedPlan().toString()


def test_collapsed_rows_move_no_names(spark):
    """Equal rows count once, rows of one molecule that differ in the name or strand apart; an absent name is one."""
    from celltally.operators import counts as cnt

    names = ["r:1:U:C:7", "r:2:U:C:7", "r:1:U:C:7", None, None, "", "7"]
    rows = [("S", "exon", "c", 1, 5 + i % 2, n, x, "G ") for i in range(4) for n in names for x in "+-"]
    df = spark.createDataFrame(rows, "sample string, label string, chrom string, start long, end long, qname string, strand string, gene_fullname string")
    for dedup, made in ((True, set(rows)), (False, rows)):
        want = {}
        for s, label, c, a, b, q, _, _ in made:
            p = (q or "").split(":") if q is not None else []
            k = (s, label, c, a, b, p[-1] if p else None, p[-3] if len(p) > 2 else None, "G__c")
            want[k] = want.get(k, 0) + 1
        got = cnt.collapsed_rows(df, dedup)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(((*k, n) for k, n in want.items()), key=repr)
        moved = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[0].splitlines() if "qname" in x]
        assert not moved
