"""The corpus pipeline: quality, near duplicates, PII, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
every stage's result to the shared folder and reads it back as the next one's
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltally.llm import bpe, jaccard, mixing, pii, resample
from celltally.llm.common import col, fresh, land, named, small, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; labelled rows come from ``labels``."""
    return resample.select(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 80 %): the
    one with the smallest id. Of repeated rows of an id one stays; all rows
    without an id stay.

    The ids that go, or have several rows, are fewer than those that stay: texts
    are joined with them only, and are not exchanged while they fit a broadcast.
    """
    groups = jaccard.near_duplicates(docs)
    ident, n, stays = fresh(docs, "dealt_id"), fresh(docs, "n_rows"), fresh(docs, "stays")
    ids = groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(ident)).agg(
        F.count("*").alias(n), F.bool_or(F.col("doc_id") == F.col("component_id")).alias(stays))
    dealt = land(ids.where((F.col(n) > 1) | ~F.col(stays)), "pipeline-dealt")
    out = docs.join(small(dealt.select(ident), 16), col("doc_id") == F.col(ident), "left_anti")
    several = dealt.where(F.col(stays)).select(ident)
    if not several.isEmpty():
        again = docs.join(small(several, 16), col("doc_id") == F.col(ident)).drop(ident)
        out = out.unionByName(again.dropDuplicates([named(docs, "doc_id")]))
    return out


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and disclosing terms replaced by their kind."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, number of ids, ids (little-endian unsigned 32-bit) of every document."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    return bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The classifier's model and the encoder cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
