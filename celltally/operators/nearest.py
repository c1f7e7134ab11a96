"""Cells of observed barcodes by a pigeonhole index.

A barcode with at most ``hd`` replaced letters agrees with its whitelist entry
in at least ``kept`` of ``hd + kept`` segments. Both sides are keyed by every
choice of ``kept`` segments and joined on the key; candidates are verified
letter by letter. The work grows with the whitelist and the distinct observed
barcodes, never with length ** hd, as writing out all neighbours would.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltally.operators.barcodes import SUBSTITUTES, SUBSTITUTES_HD0
from celltally.operators.common import land

#: Whitelist entries that a key should have on average, and most segments a key is made of.
ENTRIES_PER_KEY, MOST_KEPT = 8, 3
#: Letters in one number, three bits each.
WORD_LETTERS = 21
LOW_BITS = int("1" * WORD_LETTERS, 8)


def _segment(seq: Column, i: int, n: int) -> Column:
    """Segment ``i`` of the ``n`` about equal ones of a string."""
    begin = lambda j: F.floor(F.length(seq) * j / n).cast("int")
    return F.substr(seq, begin(i) + 1, begin(i + 1) - begin(i))


def _keys(seq: Column, hd: int, kept: int) -> Column:
    n = hd + kept
    keys = [F.concat_ws("|", F.lit(str(c)), F.length(seq).cast("string"), *[_segment(seq, i, n) for i in some])
            for c, some in enumerate(combinations(range(n), kept))]
    return F.array(*keys)


def _words(seq: Column, n_words: int) -> list[Column]:
    """The letters as numbers: A, C, G, T, N and one digit for any other."""
    digits = F.translate(F.regexp_replace(seq, "[^ACGTN]", "5"), "ACGTN", "01234")
    part = lambda i: F.substr(digits, F.lit(i * WORD_LETTERS + 1), F.lit(WORD_LETTERS))
    return [F.conv(F.concat(F.lit("0"), part(i)), 8, 10).cast("long") for i in range(n_words)]


def _differing(a: str, b: str, n_words: int) -> Column:
    """In how many places two strings of one length differ, from their numbers:
    exact but for letters beyond the five, which count as equal to each other."""
    out = []
    for i in range(n_words):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        out.append(F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseAND(F.lit(LOW_BITS))))
    return reduce(lambda p, q: p + q, out)


def _reaches(seq: str, cbc: str, hd: int, letters: list[str]) -> Column:
    """Whether ``cbc`` becomes ``seq`` by at most ``hd`` letters replaced by one of ``letters``."""
    at = lambda c, i: F.substr(F.col(c), i, F.lit(1))
    places = F.filter(F.sequence(F.lit(1), F.length(seq)), lambda i: at(seq, i) != at(cbc, i))
    return (F.col(seq) == F.col(cbc)) | ((F.size(places) <= hd) & F.forall(places, lambda i: at(seq, i).isin(letters)))


def segments_kept(n_entries: int, length: int, hd: int) -> int:
    """How many segments a key is made of, so that it has few whitelist entries."""
    for kept in range(1, MOST_KEPT + 1):
        if hd + kept >= length or n_entries <= ENTRIES_PER_KEY * 4 ** (length * kept / (hd + kept)):
            break
    return kept


def observed_dictionary(observed: DataFrame, whitelist: DataFrame, hd: int, kept: int | None = None) -> DataFrame:
    """([sample,] seq, cell): ``barcodes.barcode_dictionary`` for the observed
    strings only.

    ``observed``: [sample,] cbc, any number of rows each; ``whitelist``:
    [sample,] cbc, cell. As there, hd 0 allows one letter replaced by ``N``, a
    larger one up to ``hd`` letters by one of N, C, T, G, A, and a string that
    reaches barcodes of several cells is left out. Null barcodes match nothing.
    """
    letters, far = (SUBSTITUTES_HD0, 1) if hd == 0 else (SUBSTITUTES, hd)
    sample = ["sample"] if "sample" in whitelist.columns else []
    entries = land(whitelist.select(*sample, "cbc", "cell").where("cbc IS NOT NULL").distinct(), "whitelist-entries")
    n_entries, length, longest = entries.agg(F.count("*"), F.min(F.length("cbc")), F.max(F.length("cbc"))).first()
    kept = kept or segments_kept(n_entries, length or 0, far)
    n_words = max(1, -(-(longest or 0) // WORD_LETTERS))
    numbers = lambda c, name: [w.alias(f"{name}{i}") for i, w in enumerate(_words(F.col(c), n_words))]
    seen = observed.select(*sample, F.col("cbc").alias("seq")).where(F.length("seq").between(length or 0, longest or 0)).distinct()
    left = seen.select("*", *numbers("seq", "o")).withColumn("key", F.explode(_keys(F.col("seq"), far, kept)))
    right = entries.select("*", *numbers("cbc", "w")).withColumn("key", F.explode(_keys(F.col("cbc"), far, kept)))
    near = left.join(right, [*sample, "key"]).where(_differing("o", "w", n_words) <= far).where(_reaches("seq", "cbc", far, letters))
    return near.groupBy(*sample, "seq").agg(F.count_distinct("cell").alias("n_cells"), F.min("cell").alias("cell")).where("n_cells = 1").select(*sample, "seq", "cell")
