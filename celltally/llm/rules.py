"""Quality rules with thresholds that adapt to language and source.

Counts per document come from one vectorised pass. Their ratios go into
quantile sketches per (lang, source): bucket counts of integer ratios, which
merge by adding, so any split of the rows gives the same sketch. Fences around
the quartiles replace fixed cutoffs. A group's quartiles are averaged with those
of its language, which count as ``PRIOR`` rows whatever the group's size, and a
language's likewise with those of all rows. Documents are then judged by a join
with the fences.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.llm import textkit as tk
from celltally.llm.common import col, land, ship

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: Ratio -> (numerator, factor, denominator, least distance of the fences from the quartiles).
#: Ratios are whole numbers: factor * numerator div denominator.
RATIOS = {
    "symbols": ("n_symbols", 1000, "n_words", 200),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", 300),
    "repeats": ("n_repeat_words", 1000, "n_words", 200),
    "upper": ("n_upper", 1000, "word_chars", 200),
    "word_length": ("word_chars", 100, "n_words", 300),
}
#: Sketches keep so many leading bits of a ratio: smaller ones are exact, larger ones within 1/512.
BITS = 10
#: Fences lie this many quartile distances outside the quartiles.
REACH = 4
#: Rows that the wider group's quartiles count as.
PRIOR = 20
FENCES_BROADCAST_BYTES = 8 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def count_texts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text."""
    n = len(offs) - 1
    inside = tk.IS_WORD[data]
    starts, ends, first = tk.spans(inside, offs)
    out = {"n_words": np.diff(first),
           "word_chars": tk.per_text(inside & ((data & 0xC0) != 0x80), offs),
           "n_symbols": tk.per_text(_SYMBOL[data], offs),
           "n_upper": tk.per_text((data >= 65) & (data <= 90), offs)}

    breaks = np.flatnonzero(data == 10)
    line_doc = np.repeat(np.arange(n), 1 + np.diff(np.searchsorted(breaks, offs)))
    line_start = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([breaks, offs[1:]]))
    filled = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_doc, line_start, line_end = line_doc[filled], line_start[filled], line_end[filled]
    keys = tk.mix(tk.hash_spans(data, line_start, line_end) + line_doc.astype(tk.U) * tk.M1)
    _, once = np.unique(keys, return_index=True)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[once], minlength=n)

    covered = np.zeros(len(starts), bool)
    doc = tk.owner(first)
    ok = np.flatnonzero(tk.whole(first, 3))
    if len(ok):
        three = tk.windows(tk.hash_spans(data, starts, ends), 3)[ok]
        hit = ok[_twice(tk.mix(three + doc[ok].astype(tk.U) * tk.M1))]
        for j in range(3):
            covered[hit + j] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    return out


def _count_batches(batches):
    for batch in batches:
        for part in tk.slices(batch):
            got = count_texts(*tk.text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("lang"), part.column("source"), *[pa.array(got[c].astype(np.int64)) for c in COUNTS]],
                names=["doc_id", "lang", "source", *COUNTS])


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts...): one row per document.

    A null or empty text has zero counts; repeated rows stay repeated; columns
    other than doc_id, lang, source and text are not read.
    """
    ship(docs.sparkSession)
    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), col("lang").cast("string").alias("lang"),
                       col("source").cast("string").alias("source"), col("text").cast("string").alias("text"))
    return slim.mapInArrow(_count_batches, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def ratio(name: str):
    top, factor, bottom, _ = RATIOS[name]
    value = F.expr(f"(CAST({factor} AS BIGINT) * {top}) div {bottom}")
    return F.when(F.col(bottom) > 0, value).otherwise(F.lit(0)).cast("long")


def bucket(value):
    """The ratio with all but its ``BITS`` leading bits cleared."""
    return F.expr(f"CASE WHEN {value} < {1 << BITS} THEN {value} ELSE {value} - {value} % shiftleft(1L, length(bin({value})) - {BITS}) END")


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): one mergeable sketch per group and ratio.

    At most 2 ** ``BITS`` buckets and half as many for each further doubling;
    partial sums before the shuffle keep a hot source to one row per bucket and task.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), ratio(r).alias("bucket")) for r in RATIOS])).alias("p")
    return (counts.select("lang", "source", pairs).select("lang", "source", "p.ratio", bucket("p.bucket").alias("bucket")).groupBy("lang", "source", "ratio", "bucket")
            .agg(F.count("*").alias("n")))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, <ratio>_low, <ratio>_high) for each group of the sketches."""
    def quartiles(keys):
        merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*keys, "ratio")
        below = F.sum("n").over(group.orderBy("bucket"))
        merged = merged.withColumn("below", below).withColumn("rows", F.sum("n").over(group))
        return merged.groupBy(*keys, "ratio").agg(
            F.max("rows").alias("rows"),
            F.min(F.when(F.expr("4 * below >= rows"), F.col("bucket"))).alias("q1"),
            F.min(F.when(F.expr("4 * below >= 3 * rows"), F.col("bucket"))).alias("q3"))

    own = quartiles(["lang", "source"]).alias("own")
    lang = quartiles(["lang"]).alias("lang_only")
    every = quartiles([]).alias("every")
    joined = (own.join(lang, F.col("own.lang").eqNullSafe(F.col("lang_only.lang")) & (F.col("own.ratio") == F.col("lang_only.ratio")))
              .join(every, F.col("own.ratio") == F.col("every.ratio")))
    shrunk = lambda mine, q, wider: F.expr(f"({mine}.rows * {mine}.{q} + {PRIOR} * {wider}) div ({mine}.rows + {PRIOR})")
    joined = joined.select("*", *[shrunk("lang_only", q, f"every.{q}").alias(f"lang_{q}") for q in ("q1", "q3")])
    chosen = joined.select(F.col("own.lang").alias("lang"), F.col("own.source").alias("source"), F.col("own.ratio").alias("ratio"),
                           shrunk("own", "q1", "lang_q1").alias("q1"), shrunk("own", "q3", "lang_q3").alias("q3"))
    out = []
    for name, (_, _, _, least) in RATIOS.items():
        reach = F.greatest(REACH * (F.col("q3") - F.col("q1")), F.lit(least))
        mine = F.col("ratio") == name
        out += [F.max(F.when(mine, F.col("q1") - reach)).alias(f"{name}_low"), F.max(F.when(mine, F.col("q3") + reach)).alias(f"{name}_high")]
    return chosen.groupBy("lang", "source").agg(*out)


def judged(docs: DataFrame) -> DataFrame:
    """Counts with ``base_failed`` and ``kept``, one row per document.

    The base rule fails texts of fewer than 50 words, or with over half of
    their words in repeated three-word windows; the others are kept if every
    ratio lies within the fences of their (lang, source). Null languages and
    sources are groups of their own. An empty table gives an empty result.
    """
    counts = land(counted(docs), "rule-counts")
    bounds = land(fences(sketches(counts)), "rule-fences")
    size_of = bounds.agg(F.sum(F.coalesce(F.octet_length("lang"), F.lit(0)) + F.coalesce(F.octet_length("source"), F.lit(0)) + 128)).first()[0] or 0
    bounds = bounds.withColumnsRenamed({"lang": "group_lang", "source": "group_source"})
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = reduce(lambda a, b: a & b, [ratio(r).between(F.col(f"{r}_low"), F.col(f"{r}_high")) for r in RATIOS])
    return (counts.join(F.broadcast(bounds) if size_of <= FENCES_BROADCAST_BYTES else bounds,
                        F.col("lang").eqNullSafe(F.col("group_lang")) & F.col("source").eqNullSafe(F.col("group_source")), "left")
            .select("doc_id", *COUNTS, base.alias("base_failed"), (~base & within).alias("kept")))


def report(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
