"""The pipeline's stages on awkward rows, and the registered queries against their SQL."""

import os

import duckdb
import numpy as np
import pytest
from test_operators import CLASH, ROWS, SCHEMA  # noqa: E402

import corpus_pipeline as P
from celltally.llm import oracle, queries
from celltally.llm.common import land
from pyspark.sql import functions as F

TABLES = ("documents", "conversations")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASH:
        docs = docs.withColumn(c, F.lit("clash"))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1), (12, 1), (-4, 0), (11, 0)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(P.STAGES):
        out = land(stage(spark, docs, folder), "stage")
        assert out.count() > 0, name
        if i < 4:
            assert out.columns == columns and out.dtypes == spark.read.parquet(f"{folder}/documents.parquet").dtypes, name
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in out.select("doc_id").collect()} <= before
        if name == "near_duplicates":
            ids = [r.doc_id for r in out.select("doc_id").collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids)) and not {2, 4} & set(ids)
        if name == "private_data":
            assert out.count() == docs.count() and out.where("text like '%@c.de%'").count() == 0
        docs = out
    assert docs.columns == ["doc_id", "n_tokens", "ids"]
    assert all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in docs.collect())


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("key", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, sf_small, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    con.execute(f"CREATE VIEW checked AS {oracle.SQL[key]}")
    rel = con.sql("SELECT * FROM checked")
    df = queries.QUERIES[key](spark, sf_small)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = sorted((tuple(norm(x) for x in r) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall()), key=repr)
    assert got == want


def test_one_query_per_operator():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert os.path.basename(P.__file__) == "corpus_pipeline.py" and len(P.STAGES) == 5
