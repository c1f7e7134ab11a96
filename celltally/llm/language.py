"""Language identification by averaged hashed subword embeddings.

A text's features are the byte 2-, 3- and 4-grams of its words (boundaries
included), hashed into ``BUCKETS`` embeddings. Their average goes through a
linear softmax over the learned languages. Embeddings and softmax are trained
together by stochastic gradient descent in numpy, on a bounded sample of
labelled rows whose texts are cut into pieces of 1, 2, 4, ... words, so that
short texts are learned too. A share of the sample is kept from training: it
sets the temperature of the scores, and the score below which a prediction is
rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltally.llm import textkit as tk
from celltally.llm.common import col, fresh, land, named, ship

#: Embeddings and their width.
BUCKETS, WIDTH = 1 << 14, 16
ORDERS = (2, 3, 4)
#: Labelled rows used, about, those with the smallest hashes of each language.
FIT_ROWS = 2_400
#: One row in so many of them is kept from training, for the calibration.
KEPT_BACK = 4
EPOCHS, BATCH, RATE = 12, 128, 2.0
#: Share of the accepted predictions that must be right among the rows kept back.
TARGET = 0.99
SEED = 11
UNKNOWN = "und"

#: Bytes of letters (ASCII ones in lower case, all others beyond ASCII); anything else parts words.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def subwords(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of texts in order of their places: buckets, the offsets of
    the texts among them, and the byte each begins at.

    An n-gram may begin or end with one space for a word's border, and has a
    letter byte everywhere else. Each text is taken between two spaces.
    """
    n = len(offs) - 1
    at = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, np.diff(offs))
    text = np.full(len(data) + 2 * n, 32, np.uint8)
    text[at] = _FOLD[data]
    letter = text != 32
    place, bucket = [], []
    for k in ORDERS:
        m = max(len(text) - k + 1, 0)
        ok = np.ones(m, bool)
        for j in range(1, k - 1):
            ok &= letter[j:j + m]
        ok &= letter[:m] | letter[k - 1:k - 1 + m]
        if k == 2:
            ok = letter[:m] & letter[1:1 + m]
        at = np.flatnonzero(ok)
        h = np.zeros(len(at), np.uint32)
        for j in range(k):
            h = (h + text[at + j]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        place.append(at)
        bucket.append((h + np.uint32(k)) * np.uint32(0x85EBCA77) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    place, bucket = np.concatenate(place), np.concatenate(bucket).astype(np.int64)
    order = np.argsort(place, kind="stable")
    place, bucket = place[order], bucket[order]
    starts = offs + 2 * np.arange(n + 1)
    upto = np.searchsorted(place, starts)
    return bucket, upto, place - np.repeat(2 * np.arange(n) + 1, np.diff(upto))


def averaged(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Means of consecutive rows, zero where there is none."""
    n = np.diff(upto)
    out = np.zeros((len(n), values.shape[1]))
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(values, upto[:-1][some], axis=0, dtype=np.float64) / n[some, None]
    return out


def bags(batches):
    """Labelled texts -> pieces of 1, 2, 4, ... words that cover the text, as distinct buckets with their numbers."""
    for batch in batches:
        for part in tk.slices(batch):
            data, offs = tk.text_bytes(part.column("text"))
            bucket, upto, place = subwords(data, offs)
            spans = [np.zeros(0, np.int64)]
            _, ends, first = tk.words(data, offs)
            for i in range(len(offs) - 1):
                cuts = (1 << np.arange(1, 40)) - 2
                cuts = cuts[cuts < first[i + 1] - first[i]]
                spans.append(np.searchsorted(place[upto[i]:upto[i + 1]], ends[first[i] + cuts]) + upto[i] if len(cuts) else np.zeros(0, np.int64))
            rows = []
            for i, mark, lang in zip(range(len(offs) - 1), part.column("mark").to_pylist(), part.column("lang").to_pylist(), strict=True):
                for a, b in zip([upto[i], *spans[i + 1]], [*spans[i + 1], upto[i + 1]], strict=True):
                    which, times = np.unique(bucket[a:b], return_counts=True)
                    if len(which):
                        rows.append((mark, lang, which.astype("<i4").tobytes(), (times / times.sum()).astype("<f4").tobytes()))
            mark, lang, which, share = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(mark, pa.int64()), pa.array(lang, pa.string()), pa.array(which, pa.binary()), pa.array(share, pa.binary())],
                                             names=["mark", "lang", "which", "share"])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def trained(which: list[np.ndarray], share: list[np.ndarray], label: np.ndarray, n_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Logits that each bucket adds to a text (its embedding times the softmax
    weights), and the bias. Stochastic gradient descent with a falling rate;
    languages weigh alike."""
    rnd = np.random.default_rng(SEED)
    table = rnd.normal(0, 0.1, (BUCKETS, WIDTH))
    weights, bias = rnd.normal(0, 0.1, (WIDTH, n_labels)), np.zeros(n_labels)
    balance = len(label) / n_labels / np.maximum(np.bincount(label, minlength=n_labels), 1)
    steps, step = EPOCHS * math.ceil(len(label) / BATCH), 0
    for _ in range(EPOCHS):
        order = rnd.permutation(len(label))
        for begin in range(0, len(order), BATCH):
            rows = order[begin:begin + BATCH]
            bucket, by = np.concatenate([which[r] for r in rows]), np.concatenate([share[r] for r in rows])
            size = np.array([len(which[r]) for r in rows])
            upto = np.concatenate([[0], np.cumsum(size)])
            mean = np.add.reduceat(table[bucket] * by[:, None], upto[:-1], axis=0)
            wrong = softmax(mean @ weights + bias)
            wrong[np.arange(len(rows)), label[rows]] -= 1
            wrong *= balance[label[rows], None] / len(rows)
            rate = RATE * (1 - step / steps)
            step += 1
            back = np.repeat(wrong @ weights.T, size, axis=0) * by[:, None]
            weights -= rate * (mean.T @ wrong)
            bias -= rate * wrong.sum(0)
            distinct, inverse = np.unique(bucket, return_inverse=True)
            for d in range(WIDTH):  # rate per embedding: a bucket is met in few texts of a batch
                table[distinct, d] -= rate * len(rows) / 8 * np.bincount(inverse, back[:, d], len(distinct))
    return table @ weights, bias


def calibrated(logits: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """The temperature that makes the scores of held-back rows likeliest, one
    more row being taken as wrong so that n right ones prove no certainty, and
    the least score from which on ``TARGET`` of them are right."""
    if not len(label):
        return 1.0, 0.0
    n, k = logits.shape
    truth = np.full((n, k), 1 / (n + 1) / k)
    truth[np.arange(n), label] += n / (n + 1)
    loss = lambda t: -(truth * np.log(np.maximum(softmax(logits / t), 1e-300))).sum()
    temperature = min((float(2.0 ** e) for e in np.linspace(-6, 4, 81)), key=loss)
    p = softmax(logits / temperature)
    score, right = p.max(1), p.argmax(1) == label
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / (1 + np.arange(len(order)))
    last = np.append(score[order][1:] < score[order][:-1], True)  # equal scores are accepted together
    good = np.flatnonzero(last & (share >= TARGET))
    return temperature, float(score[order][good[-1]]) if len(good) else 1.0


def fit(batches):
    """Trains on all bags of its input, a bounded sample, and returns the model in one row."""
    rows = sorted((r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("mark", "lang", "which", "share")), strict=True)),
                  key=lambda r: (r[0], r[1], r[2], r[3]))
    langs = sorted({r[1] for r in rows})
    if not langs:
        return
    label = np.array([langs.index(r[1]) for r in rows])
    back = np.array([r[0] % KEPT_BACK == 0 for r in rows])
    which, share = [np.frombuffer(r[2], "<i4") for r in rows], [np.frombuffer(r[3], "<f4") for r in rows]
    train = np.flatnonzero(~back)
    if not len(train):
        train = np.arange(len(rows))
    logits, bias = trained([which[i] for i in train], [share[i] for i in train], label[train], len(langs))
    test = np.flatnonzero(back)
    means = np.array([share[i] @ logits[which[i]] + bias for i in test]).reshape(len(test), len(langs))
    temperature, least = calibrated(means, label[test])
    yield pa.RecordBatch.from_arrays([pa.array([langs]), pa.array([logits.astype("<f4").tobytes()]), pa.array([bias.tobytes()]), pa.array([temperature]), pa.array([least])],
                                     names=["langs", "logits", "bias", "temperature", "least"])


def model(labelled: DataFrame, fit_rows: int = FIT_ROWS):
    """The fitted model of rows (doc_id, text, lang), or None without any label.

    Each language gives about ``fit_rows`` divided by the number of languages:
    its rows with the smallest hashes of doc_id and text (all, if fewer). A
    null text or lang is left out; equal rows count once; of more than
    ``fit_rows`` languages the most frequent are learned.
    """
    spark = labelled.sparkSession
    ship(spark)
    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(F.xxhash64("doc_id", "text", F.lit(SEED)).alias("mark"), "text", "lang")
    n_rows = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(fit_rows).collect()}
    if not n_rows:
        return None
    shares = [(lang, min(1.0, fit_rows / len(n_rows) / n)) for lang, n in n_rows.items()]
    shares = spark.createDataFrame(shares, "lang string, part double")
    unit = F.shiftrightunsigned("mark", 11) / F.lit(float(1 << 53))
    sample = known.join(F.broadcast(shares), "lang").where(unit < F.col("part")).select("mark", "text", "lang")
    sample = land(sample.distinct(), "language-sample")
    rows = sample.select(F.shiftrightunsigned("mark", 1).alias("mark"), "lang", "text").mapInArrow(bags, "mark long, lang string, which binary, share binary")
    return rows.repartition(1).mapInArrow(fit, "langs array<string>, logits binary, bias binary, temperature double, least double").first()


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predicted(docs: DataFrame, fitted) -> tuple[DataFrame, str, str, str]:
    """``docs`` with language, score and whether the prediction is accepted, and
    the names of the three columns.

    The score is the calibrated probability. Null texts and texts without a
    letter are ``und``, with score 0 and not accepted; so is everything without
    a model. Letters that give no n-gram (one-letter words) leave the bias.
    """
    ship(docs.sparkSession)
    lang, score, accepted = (fresh(docs, c) for c in ("lang_pred", "score", "accepted"))
    text = named(docs, "text")
    if fitted is None:
        return docs.withColumns({lang: F.lit(UNKNOWN), score: F.lit(0.0), accepted: F.lit(False)}), lang, score, accepted
    shared = docs.sparkSession.sparkContext.broadcast(fitted.asDict())  # BUCKETS floats for each language

    def run(batches):
        m = shared.value
        bias = np.frombuffer(m["bias"])
        logits = np.frombuffer(m["logits"], "<f4").reshape(BUCKETS, len(bias))
        langs = np.array(m["langs"], object)
        for batch in batches:
            for part in tk.slices(batch, text):
                bucket, upto, _ = subwords(*tk.text_bytes(part.column(text)))
                p = softmax((averaged(logits[bucket], upto) + bias) / m["temperature"])
                best = p.argmax(1)
                top = np.clip(p[np.arange(len(best)), best], 0, 1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs[best], pa.string()), pa.array(top), pa.array(top >= m["least"])],
                                                 names=[*part.schema.names, lang, score, accepted])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{lang} string, {score} double, {accepted} boolean"])
    found, letters = docs.mapInArrow(run, schema), has_letter(col(text))
    return found.withColumns({lang: F.when(letters, F.col(lang)).otherwise(UNKNOWN), score: F.when(letters, F.col(score)).otherwise(0.0),
                              accepted: F.col(accepted) & letters}), lang, score, accepted


def held_out(doc_id: Column) -> Column:
    """Rows that test the model and are not learned from (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def report(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The registered query: (doc_id, held_out, lang_pred, score, accepted), one row per row of ``docs``.

    Learns from rows that are not held out and have a doc_id, a text and a lang.
    A null doc_id is neither held out nor learned from; rows of one id are judged each by its own text;
    an empty table gives an empty result; other columns are not read.
    """
    slim = docs.select(col("doc_id").alias("doc_id"), col("text").cast("string").alias("text"), col("lang").cast("string").alias("lang"))
    fitted = model(slim.where(~held_out(F.col("doc_id"))), fit_rows)
    rows, lang, score, accepted = predicted(slim.select("doc_id", "text"), fitted)
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"), F.col(accepted).alias("accepted"))
