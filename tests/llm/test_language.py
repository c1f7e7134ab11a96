"""Language identification: features against brute force, accuracy on rows that were not learned from."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from test_operators import CLASH, ROWS, SCHEMA

from celltally.llm import language
from celltally.llm import textkit as tk


def brute_grams(text):
    folded = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    padded, out = b" " + folded + b" ", []
    for k in language.ORDERS:
        for i in range(len(padded) - k + 1):
            g = padded[i:i + k]
            if b" " not in g[1:-1] and (g.count(b" ") <= 1 if k > 2 else b" " not in g):
                out.append(g)
    return out


def bucket_of(gram):
    h = 0
    for b in gram:
        h = (h + b) * 0x9E3779B1 % 2**32
        h ^= h >> 15
    return (h + len(gram)) * 0x85EBCA77 % 2**32 >> 18


def test_subwords_equal_brute_force():
    texts = ["Hello wörld, a-b 12 x", "", "é", "  The  END", "日本 x"]
    data, offs = tk.text_bytes(pa.array(texts))
    bucket, upto, place = language.subwords(data, offs)
    for i, t in enumerate(texts):
        assert sorted(bucket[upto[i]:upto[i + 1]].tolist()) == sorted(map(bucket_of, brute_grams(t)))
        assert ((place[upto[i]:upto[i + 1]] >= offs[i] - 1) & (place[upto[i]:upto[i + 1]] < offs[i + 1])).all()


def prose(rnd, lang, n):
    syllables = {"xx": ["ka", "to", "mi", "ro", "ne"], "yy": ["schl", "ung", "ver", "ein", "pf"], "zz": ["ção", "lhe", "dos", "nha", "que"]}[lang]
    return " ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(n))


def test_accuracy_and_calibration(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(900):
        lang = rnd.choice(["xx", "xx", "yy", "zz"])
        rows.append((i, prose(rnd, lang, rnd.choice([1, 2, 5, 40, 200])), lang))
    mixed = [(10_000 + i, prose(rnd, "xx", 20) + " " + prose(rnd, "yy", 20), None) for i in range(20)]
    docs = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language.report(docs, fit_rows=300).collect()}
    truth = {i: lang for i, _, lang in rows}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(out[i].held_out == (i in set(held)) for i in truth)
    right = [out[i].lang_pred == truth[i] for i in held]
    assert np.mean(right) >= 0.98
    accepted = [out[i].lang_pred == truth[i] for i in held if out[i].accepted]
    assert np.mean(accepted) >= 0.98 and len(accepted) > 0.8 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())
    assert np.mean([out[i].score for i, _, _ in mixed]) < np.mean([out[i].score for i in held])


def test_labels_ids_and_sources_are_no_inputs(spark):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, lang := rnd.choice(["xx", "yy"]), 30), lang, "a") for i in range(200)]
    learned = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.model(learned.where(~language.held_out(F.col("doc_id"))), 100)
    both = spark.createDataFrame([(1, rows[0][1], "yy", "a"), (2, rows[0][1], None, "b")], learned.schema)
    rows, lang, score, _ = language.predicted(both, model)
    one, two = rows.select(lang, score).collect()
    assert one == two
    assert language.model(learned.where(~language.held_out(F.col("doc_id"))), 100) == model  # reruns agree


def test_awkward_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for c in (*CLASH, "lang_pred", "accepted", "held_out", "mark"):
        docs = docs.withColumn(c, F.lit("clash"))
    out = language.report(docs).collect()
    assert len(out) == len(ROWS)
    langs = {r[2] for r in ROWS if r[2] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
        assert r.lang_pred in langs | {"und"}
    for i, text, *_ in ROWS:
        if text is None or not any(c.isalpha() for c in text):
            assert all(r.lang_pred == "und" and r.score == 0 and not r.accepted for r in by_id[i])
    rows, lang, score, accepted = language.predicted(docs, None)
    assert {lang, score, accepted} == {"_lang_pred", "score", "_accepted"} and rows.columns[:-3] == docs.columns
    assert {r[lang] for r in rows.collect()} == {"und"}


def test_without_rows_or_labels(spark):
    assert language.report(spark.createDataFrame([], SCHEMA)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None), (None, "more", "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.report(unlabelled).collect()} == {"und"}
