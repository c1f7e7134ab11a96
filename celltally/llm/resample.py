"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are estimated: one of the target text
(labelled good), one of the raw text (all documents). A document's log weight
is the log ratio of its probabilities under the two. Documents are sampled
without replacement by Gumbel top-k: noise hashed from the id is added to the
log weights and the k largest stay, k being the number of documents whose log
weight is above the point that parts good and bad rows best among held-out
labels.

N-grams are the byte triples of a text, and for each pair of neighbouring words
whether they are the same.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm import textkit as tk
from celltally.llm.common import col, fresh, land, named, ship

#: Buckets of byte triples; two more count equal and different neighbour words.
SLOTS = 1 << 16
#: Labelled rows used, at most, those with the smallest hashes of their ids.
FIT_ROWS = 20_000
#: One labelled row in so many is held out to place the cut.
HELD_OUT = 4
#: Counts added to a slot in both models, in proportion to the raw one: a slot
#: that the target sample should have met less often than this says little.
SMOOTH = 2.0
SEED = 7
_TRIPLE = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all triples with their texts' offsets, and of all word pairs likewise."""
    n = max(len(data) - 2, 0)
    h = data[:n].astype(np.uint32) * _TRIPLE[0] + data[1:n + 1].astype(np.uint32) * _TRIPLE[1] + data[2:n + 2].astype(np.uint32) * _TRIPLE[2]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    inside = np.ones(n, bool)
    for j in (1, 2):
        at = offs[1:] - j
        inside[at[(at >= 0) & (at < n)]] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    starts, ends, first = tk.words(data, offs)
    w = tk.hash_spans(data, starts, ends)
    same = np.zeros(len(w), np.int64)
    same[1:] = w[1:] == w[:-1]
    pair = np.ones(len(w), bool)
    pair[first[:-1][first[:-1] < len(w)]] = False
    pairs = np.concatenate([[0], np.cumsum(pair)])
    return (h[inside] >> np.uint32(16)).astype(np.int64), kept[np.minimum(offs, n)], SLOTS + same[pair], pairs[first]


def summed(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(values)])
    return upto[offs[1:]] - upto[offs[:-1]]


def model(docs: DataFrame) -> np.ndarray:
    """Log ratio of target to raw probability per slot. ``docs``: text, label
    (1: in the target sample)."""
    def run(batches):
        raw, good = np.zeros(SLOTS + 2, np.int64), np.zeros(SLOTS + 2, np.int64)
        for batch in batches:
            for part in tk.slices(batch):
                triples, at, pairs, pair_at = grams(*tk.text_bytes(part.column("text")))
                target = part.column("label").fill_null(0).to_numpy(zero_copy_only=False) == 1
                for slots, offs in ((triples, at), (pairs, pair_at)):
                    raw += np.bincount(slots, minlength=SLOTS + 2)
                    good += np.bincount(slots[np.repeat(target, np.diff(offs))], minlength=SLOTS + 2)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, raw[seen], good[seen])], names=["slot", "raw", "good"])

    counts = docs.mapInArrow(run, "slot long, raw long, good long").groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    raw, good = np.zeros(SLOTS + 2), np.zeros(SLOTS + 2)
    for r in counts.collect():  # SLOTS + 2 rows at most
        raw[r.slot], good[r.slot] = r.raw, r.good
    out = np.zeros(SLOTS + 2)
    for part in (slice(0, SLOTS), slice(SLOTS, SLOTS + 2)):
        expected = raw[part] * (good[part].sum() / max(raw[part].sum(), 1))
        out[part] = np.log((good[part] + SMOOTH) / (expected + SMOOTH))
    return out


def noise(ids: np.ndarray, seed: int) -> np.ndarray:
    """Gumbel noise from hashed ids."""
    h = tk.mix(tk.mix(ids.astype(np.int64).view(tk.U) * tk.M1 + tk.U(seed)))
    u = ((h >> tk.U(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return -np.log(-np.log(u))


def scored(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> tuple[DataFrame, str, str]:
    """``docs`` with log weight and Gumbel key, and the names of the two columns."""
    ship(docs.sparkSession)
    weight, key, text, ident = fresh(docs, "log_weight"), fresh(docs, "gumbel_key"), named(docs, "text"), named(docs, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            for part in tk.slices(batch, text):
                triples, at, pairs, pair_at = grams(*tk.text_bytes(part.column(text)))
                w = np.round(summed(shared.value[triples], at) + summed(shared.value[pairs], pair_at), 6)
                ids = part.column(ident).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(w), pa.array(w + noise(ids, seed))], names=[*part.schema.names, weight, key])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{weight} double", f"{key} double"])
    return docs.mapInArrow(run, schema), weight, key


def best_cut(scores: list[tuple[float, int]]) -> float:
    """The score that parts good (1) from bad (0) rows best: most of both
    shares right; among equals, the middle of the widest gap. Without both
    kinds of rows nothing is cut off."""
    rows = sorted(scores)
    good, bad = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    if not good or not bad:
        return -math.inf
    best, cut, below_good, below_bad = (-1.0, 0.0), -math.inf, 0, 0
    for (s, y), (nxt, _) in zip(rows, rows[1:]):
        below_good, below_bad = below_good + y, below_bad + 1 - y
        if nxt > s:
            rank = (round(below_bad / bad - below_good / good, 9), nxt - s)
            if rank > best:
                best, cut = rank, (s + nxt) / 2
    return cut


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest ``key``, by narrowing histograms (4,097 rows a round reach the driver)."""
    lo, hi = keys.agg(F.min("key"), F.max("key")).first()
    while lo < hi:
        width = (hi - lo) / 4096
        inside = keys.where(F.col("key").between(lo, hi))
        bins = inside.groupBy(F.floor((F.col("key") - lo) / F.lit(width)).alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        above = keys.where(F.col("key") > hi).count()
        for r in sorted(bins, key=lambda r: -r.bin):
            if above + r.n >= k:
                lo, hi = r.lo, r.hi
                break
            above += r.n
        if above + r.n == k:
            return lo
    return lo


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """The model's log ratios and the cut.

    ``labels``: doc_id, quality (1 good, 0 bad; others are left out; with
    several rows for an id the worst counts). At most ``fit_rows`` are used.
    """
    ship(docs.sparkSession)
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg(F.min("quality").cast("int").alias("quality")))
    known = known.withColumn("mark", F.xxhash64("label_id", F.lit(SEED))).orderBy("mark", "label_id").limit(fit_rows)
    known = land(known, "quality-labels")
    texts = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").cast("string").alias("text"))
    labelled = texts.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"), "left")  # fit_rows rows of 20 bytes
    held = F.pmod(F.col("mark"), F.lit(HELD_OUT)) == 0
    ratios = model(labelled.select("text", F.when(~held, F.col("quality")).alias("label")))
    test = texts.join(F.broadcast(known.where(held)), F.col("doc_id") == F.col("label_id"))
    rows, weight, _ = scored(test.select("doc_id", "text", "quality"), ratios)
    return ratios, best_cut([(r[0], r[1]) for r in rows.select(weight, "quality").collect()])  # at most fit_rows rows per copy of an id


def resampled(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, seed: int = SEED) -> tuple[DataFrame, str, str, float]:
    """``docs`` with log weight and key (names returned), and the least key that stays.

    Null and empty texts have weight 0; repeated rows have equal keys and stay
    or go together (ties of the k-th key stay); a null doc_id draws the noise
    of id 0; columns of ``docs`` are kept as they are; an empty table gives an
    empty result.
    """
    ratios, cut = fitted(docs, labels, fit_rows)
    rows, weight, key = scored(docs, ratios, seed)
    slim, w, g = scored(docs.select(col("doc_id").alias("doc_id"), col("text").alias("text")), ratios, seed)
    slim = land(slim.select(F.col(w).alias("weight"), F.col(g).alias("key")), "quality-keys")
    k = slim.where(F.col("weight") > cut).count()
    least = kth_largest(slim, k) if k else math.inf
    return rows, weight, key, least


def select(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that the sample keeps."""
    rows, weight, key, least = resampled(docs, labels, fit_rows)
    return rows.where(F.col(key) >= least).drop(weight, key)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: one row per document with its verdict."""
    rows, weight, key, least = resampled(docs.select("doc_id", "text"), labels)
    return rows.select("doc_id", F.col(weight).alias("log_weight"), F.col(key).alias("gumbel_key"), (F.col(key) >= least).alias("kept"))
