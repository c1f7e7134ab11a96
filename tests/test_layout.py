"""The bucketed layout of overlap rows against the plain operators."""

import random

import pytest
from pyspark.sql import functions as F

from celltally.operators import counts as cnt
from celltally.operators import intervals as iv
from celltally.plans import layout

SCHEMA = "sample string, label string, chrom string, start long, end long, qname string, strand string, gene_fullname string"


def overlaps(spark, n=6_000):
    """Rows of two samples, a third of them on one interval, some repeated."""
    rnd, out = random.Random(1), []
    for i in range(n):
        start = 5_000 if i % 3 == 0 else rnd.randint(0, 40_000)
        row = (f"S{i % 2}", "exon" if i % 3 == 0 else rnd.choice(["exon", "intron"]), "c1" if i % 3 == 0 else rnd.choice(["c1", "c2"]), start,
               start + (50 if i % 3 == 0 else rnd.randint(1, 60)), f"r{i}:x:{rnd.choice(['AC', 'GT', 'TT'])}:x:00{rnd.randint(1, 3)}", rnd.choice("+-"), f"g{rnd.randint(0, 9)}__{i % 2}")
        out += [row] * rnd.choice([1, 1, 2])
    return spark.createDataFrame(out, SCHEMA).repartition(4)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def case(spark):
    raw = overlaps(spark).cache()
    blocks = raw.select("sample", "chrom", "start", "end")
    table = layout.IntervalTable(raw, blocks, n_buckets=16, rows_per_bucket=150)
    yield raw, table
    table.drop()


def test_same_rows_and_molecules(case):
    raw, table = case
    want = iv.clean_overlaps(raw)
    assert rows(table.rows.select(*iv.OVERLAP_COLS)) == rows(want["overlaps"])
    assert rows(table.clean) == rows(want["clean"]) and 0 < table.clean.count() < table.rows.count()
    assert rows(table.molecules) == rows(cnt.molecules(want["clean"]))


def test_a_hot_interval_is_in_many_buckets(case):
    _, table = case
    hot = table.rows.where("chrom = 'c1' AND start = 5000 AND label = 'exon'")
    assert hot.select("salt").distinct().count() >= 8
    assert table.rows.where("chrom = 'c2'").select("salt").distinct().count() <= 3
    per_file = table.rows.groupBy(F.input_file_name()).count().agg(F.max("count"), F.avg("count"), F.count("*")).first()
    assert per_file[2] <= 16 and per_file[0] <= 4 * per_file[1]


def test_rows_are_exchanged_once(spark, case):
    """Reading the table, nothing but the blocked pieces is exchanged for the anti-join."""
    _, table = case
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.clean._jdf.queryExecution().executedPlan().toString()
        distinct = table.rows.select(*layout.KEYS).distinct()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SelectedBucketsCount: 16 out of 16" in plan and plan.count("Exchange") == 1
    assert "Exchange" not in distinct


def test_molecules_and_counts_move_once(spark, case):
    _, table = case
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cnt.gene_cell_counts(table.molecules)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange") == 2  # the blocked pieces, and the molecules to their cell and gene
