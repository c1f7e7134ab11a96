"""Document fingerprints by locally consistent parsing.

A text is a sequence of bytes. Deterministic coin tossing gives each symbol a
label of a few values that depends on it and a handful of symbols before it;
local maxima of the labels begin phrases, runs of equal symbols counting as one.
Phrases are named by a hash of what they hold, the names are the symbols of the
next level, and so on up to one name. Equal substrings are cut alike but near
their ends, wherever they stand, so they share the names inside.

A fingerprint holds the name of the whole text and, for the lowest three
levels of names, up to ``KEEP`` smallest (a sample that two texts share to the
degree they share names). ``likeness`` estimates the Jaccard similarity.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm import slabs
from celltally.llm import textkit as tk
from celltally.llm.common import col, ship

LEVELS = (1, 2, 3)
KEEP = 32
#: A level is compared where both texts have this many names.
ENOUGH = 8
SLICE_BYTES = 2 << 20

U = np.uint64
_LOWEST = np.array([0] + [(i & -i).bit_length() - 1 for i in range(1, 256)], np.uint8)


def toss(y: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Labels 0..5, different for neighbours, from symbols that differ from the
    one before; ``begins`` marks the first symbols of texts."""
    for _ in range(4 if y.dtype == U else 3):
        before = np.empty_like(y)
        before[0], before[1:] = y[0], y[:-1]
        before[begins] = y[begins] ^ y.dtype.type(1)
        differ = y ^ before
        if y.dtype == U:
            lowest = differ & (U(0) - differ)
            place = (np.frexp(lowest.astype(np.float64))[1] - 1).astype(np.uint8)
            y = place * np.uint8(2) + ((y & lowest) != 0)
        else:
            place = _LOWEST[differ]
            y = place * np.uint8(2) + (y >> place & np.uint8(1))
    return y


def level_up(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each text, and the texts' offsets among them."""
    n = len(symbols)
    begins = np.zeros(n, bool)
    begins[first[:-1][first[:-1] < first[1:]]] = True
    run = begins.copy()
    run[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(run)
    y, lead = symbols[at], begins[at]
    length = np.diff(np.append(at, n))
    label = toss(y, lead)
    phrase = lead.copy()
    if len(y) > 2:
        inner = ~lead[1:-1] & ~lead[2:]
        phrase[1:-1] |= inner & (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    p = np.flatnonzero(phrase)
    size = np.diff(np.append(p, len(y)))
    place = np.arange(len(y)) - np.repeat(p, size)
    value = tk.mix(y.astype(U) * tk.M1 + length.astype(U) * tk.M2 + place.astype(U) * tk.M3)
    names = tk.mix(np.add.reduceat(value, p) + size.astype(U) * tk.M1)
    return names, np.searchsorted(p, np.searchsorted(at, first))


def smallest(names: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The ``KEEP`` smallest distinct names (32 bits) of each text."""
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first)).astype(U)
    keys = np.unique(doc << U(32) | names >> U(32))
    cuts = np.searchsorted(keys, np.arange(len(first), dtype=np.int64).astype(U) << U(32))
    low = keys.astype(np.uint32)
    return [low[a:min(b, a + KEEP)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def fingerprints(data: np.ndarray, offs: np.ndarray) -> list[str]:
    """One fingerprint per text: name of the whole and the samples of names,
    as hexadecimal numbers: ``name/level 1/level 2/level 3``."""
    n = len(offs) - 1
    top = np.zeros(n, U)
    parts = [[""] * n for _ in LEVELS]
    alive = np.flatnonzero(np.diff(offs) > 0)
    symbols, first, level = data, np.append(offs[:-1][alive], offs[-1]), 0
    while len(alive):
        symbols, first = level_up(symbols, first)
        level += 1
        if level in LEVELS:
            for doc, s in zip(alive, smallest(symbols, first), strict=True):
                parts[level - 1][doc] = s.astype(">u4").tobytes().hex()
        size = np.diff(first)
        done = (size == 1) & (level >= max(LEVELS))
        top[alive[done]] = symbols[first[:-1][done]]
        symbols = symbols[tk.gather(first[:-1][~done], size[~done])]
        first, alive = np.concatenate([[0], np.cumsum(size[~done])]), alive[~done]
    return [f"{t:016x}/{a}/{b}/{c}" for t, a, b, c in zip(top.tolist(), *parts, strict=True)]


def likeness(a: str, b: str) -> float:
    """Estimated share of names that two texts have in common, 0 to 1: at the
    highest level where both have enough, else at the lowest."""
    if a == b:
        return 1.0
    one, two = a.split("/")[1:], b.split("/")[1:]
    level = max((i for i in range(len(LEVELS)) if min(len(one[i]), len(two[i])) >= 8 * ENOUGH), default=0)
    x = {one[level][i:i + 8] for i in range(0, len(one[level]), 8)}
    y = {two[level][i:i + 8] for i in range(0, len(two[level]), 8)}
    if not x or not y:
        return 0.0
    k = min(KEEP, max(len(x), len(y))) if max(len(x), len(y)) == KEEP else len(x | y)
    least = sorted(x | y)[:k]
    return sum(v in x and v in y for v in least) / len(least)


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), one row per document; a null text is an empty one.

    Repeated rows stay; other columns are not read; an empty table gives an
    empty result.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in tk.slices(batch, limit=SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fingerprints(*tk.text_bytes(part.column("text"))), pa.string())],
                                                 names=["doc_id", "fingerprint"])

    return (docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fingerprint string"))


def edited(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all texts but the last: the text whose last half of code points is
    replaced by the first as many of the next one. Returns bytes, offsets and
    the code points of every text."""
    point = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    base = np.searchsorted(point, offs)
    n = np.diff(base)
    half = n[:-1] // 2
    own_end = point[base[:-2] + n[:-1] - half]
    own_end = np.where(half == 0, offs[1:-1], own_end)
    next_end = point[base[1:-1] + np.minimum(half, n[1:])]
    starts = np.stack([offs[:-2], offs[1:-1]], 1).ravel()
    lengths = np.stack([own_end - offs[:-2], next_end - offs[1:-1]], 1).ravel()
    upto = np.concatenate([[0], np.cumsum(lengths)])[::2]
    return data[tk.gather(starts, lengths)], upto, n


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_slab(table: pa.Table) -> pa.Table:
    """A slab's rows with the fingerprint of each text, of its edited text, and
    their likeness; the row marked ``after`` is the document that follows."""
    table = table.sort_by([("after", "ascending"), ("key", "ascending"), ("text", "ascending")])
    n_own = int(pa.compute.sum(pa.compute.invert(table.column("after"))).as_py() or 0)
    rows, row = [], 0
    table = table.slice(0, n_own + 1)
    sizes = np.diff(tk.text_bytes(table.column("text"))[1])
    while row < n_own:
        end = row + 1
        while end < n_own and sizes[row:end + 1].sum() <= SLICE_BYTES:
            end += 1
        part = table.slice(row, end - row + 1)  # with the next document
        data, offs = tk.text_bytes(part.column("text"))
        new, upto, n = edited(data, offs)
        own, other = fingerprints(data, offs), fingerprints(new, upto)
        sha = [hashlib.sha256(new[a:b].tobytes()).hexdigest() for a, b in zip(upto[:-1], upto[1:], strict=True)]
        rows.append(pa.table({
            "doc_id": part.column("doc_id").slice(0, end - row), "n_chars": pa.array(n[:-1]), "edited_sha256": sha, "fingerprint": own[:-1],
            "edited_fingerprint": other, "near_edited": [likeness(a, b) for a, b in zip(own, other)],
            "near_next": [likeness(a, b) for a, b in zip(own, own[1:])]}))
        row = end
    if not rows:
        return pa.table({c.split()[0]: [] for c in EDITED.split(", ")})
    return pa.concat_tables(rows)


def compared(docs: DataFrame, slab_bytes: int = slabs.SLAB_BYTES) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and the
    likeness of its fingerprint to the edited text's and the next document's.

    The next document is the next by doc_id, then text; after the last comes
    the first; a null doc_id is the smallest. Every slab gets the first
    document of the next slab as well (one number per slab reaches the driver).
    """
    base, _ = slabs.deal(docs, slab_bytes)
    base = base.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("after", F.lit(False))
    firsts = sorted((r.slab, r.key) for r in base.groupBy("slab").agg(F.min("key").alias("key")).collect())
    if not firsts:
        return docs.sparkSession.createDataFrame([], EDITED)
    follow = [(key, firsts[i - 1][0]) for i, (_, key) in enumerate(firsts)]
    follow = F.broadcast(docs.sparkSession.createDataFrame(follow, "first_key long, before int"))
    heads = (base.join(follow, base.key == follow.first_key)
             .select("doc_id", "text", F.col("before").alias("slab"), "key", F.lit(True).alias("after")))
    return base.unionByName(heads).groupBy("slab").applyInArrow(compare_slab, EDITED)
