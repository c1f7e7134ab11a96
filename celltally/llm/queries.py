"""Registered queries of the text operators; each applies its operator to the
whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from celltally.llm import bpe, chat, idfiles, jaccard, language, mixing, parsing, pii, repair, repeats, resample, rules, whiten
from celltally.llm.common import table


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85, count_links=True)


def op2_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def read_file(path: str) -> bytes:
    """A vocabulary file, read by the driver and broadcast to the tasks."""
    with open(path, "rb") as f:
        return f.read()


def op4_id_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return idfiles.report(table(spark, sf_dir, "documents"), read_file(path or public_tokenizers.path("byte_bpe_50k.json")))


def op5_bpe_codec(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    ranks = read_file(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.report(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.compared(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_chats(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_jaccard": op1_jaccard,
    "op2_quality_resampling": op2_quality_resampling,
    "op3_mix": op3_mix,
    "op4_id_files": op4_id_files,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_fingerprints": op6_fingerprints,
    "op7_quality_rules": op7_quality_rules,
    "op8_pii": op8_pii,
    "op9_repeats": op9_repeats,
    "op10_chat_format": op10_chat_format,
    "op11_repair": op11_repair,
    "op12_language": op12_language,
    "op13_whitening": op13_whitening,
}
