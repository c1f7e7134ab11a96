"""Attribute keys as columns."""

import pytest

from celltally.operators import annotation as ann

ROWS = [
    ("1", "havana", 'gene_id "G1"; gene_name "a-b"; tag "x"; tag "y";'),
    ("1", "havana", 'gene_id "G2"; note "two words"; level 2'),
    ("2", "ensembl", 'gene_id "G3"; source "own"; attribute "z"; a.b "dot"'),
    ("2", "ensembl", ""),
    ("3", None, None),
]
SCHEMA = "seqname string, source string, attribute string"


@pytest.mark.parametrize("parsed", [False, True])
def test_every_key_is_a_column(spark, parsed):
    gtf = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    wide = ann.widen_all(ann.with_attributes(gtf).drop("line_no") if parsed else gtf)
    assert wide.columns == ["seqname", "a.b", "gene_id", "gene_name", "level", "source", "tag"]
    want = [("1", "-", "G1", "a-b", "-", "-", "y"), ("1", "-", "G2", "-", "2", "-", "-"), ("2", "dot", "G3", "-", "-", "own", "-"),
            ("2", "-", "-", "-", "-", "-", "-"), ("3", "-", "-", "-", "-", "-", "-")]
    assert sorted(map(tuple, wide.collect())) == sorted(want)


def test_no_attributes(spark):
    gtf = spark.createDataFrame([], SCHEMA)
    assert ann.widen_all(gtf).columns == ["seqname", "source"] and ann.widen_all(gtf).count() == 0
    text = spark.createDataFrame([("1", "s", "no pairs here;")], SCHEMA)
    assert list(map(tuple, ann.widen_all(text).collect())) == [("1", "s")]
