"""Every registered query against its DuckDB oracle on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from celltally.oracle_queries import oracle_sql as own_sql
from celltally.queries import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    return c


def norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


def test_every_query_has_oracle():
    assert set(REGISTRY) == set(own_sql()) <= set(E.oracle_sql())
    assert len(E.queries()) >= 45


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sample", "cell", "gene", "umis_unspliced", "umis_spliced", "umis_total"]


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, sf_small, key):
    df = E.queries()[key](spark, sf_small)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[key])
    idx = [rel.columns.index(c) for c in sorted(rel.columns)]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert cols == sorted(rel.columns)
    assert got == want
