"""Cell barcodes: whitelist expansion, ambiguity removal, read assignment,
read statistics and input checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.functions.barcodes import compose_name, split_barcode, strip_prefix
from celltally.operators.common import DEFAULT_BROADCAST_BYTES, broadcast_if_small

# Fixed substitution alphabets: with a Hamming distance of 0 only an 'N' may
# replace one base; otherwise any of these five letters may.
SUBSTITUTES_HD0 = ["N"]
SUBSTITUTES = ["N", "C", "T", "G", "A"]
NO_CELL = "None"  # a cell id that counts as "no cell"


def _sample_keys(df: DataFrame) -> list[str]:
    return ["sample"] if "sample" in df.columns else []


def expand_whitelist(whitelist: DataFrame, hd: int) -> DataFrame:
    """All (seq, cell) pairs reachable from a whitelist barcode.

    hd = 0: the barcode and every copy with one base replaced by ``N``.
    hd >= 1: every string with at most ``hd`` positions replaced by one of
    N, C, T, G, A. Each round explodes positions x letters of the previous
    round and removes repeats; the result grows with whitelist x length^hd,
    never with the reads.
    """
    keys = _sample_keys(whitelist)
    letters = SUBSTITUTES_HD0 if hd == 0 else SUBSTITUTES
    rounds = max(hd, 1)
    cur = whitelist.select(*keys, F.col("cbc").alias("seq"), "cell").distinct()
    for _ in range(rounds):
        step = cur.select(
            *keys, "seq", "cell",
            F.explode(F.sequence(F.lit(1), F.greatest(F.length("seq"), F.lit(1)))).alias("p"),
        ).select(*keys, "seq", "cell", "p", F.explode(F.array(*[F.lit(c) for c in letters])).alias("letter"))
        step = step.filter(F.col("p") <= F.length("seq")).select(
            *keys, F.overlay("seq", "letter", "p", F.lit(1)).alias("seq"), "cell"
        )
        cur = cur.unionByName(step).distinct()
    return cur


def resolve_ambiguous(expanded: DataFrame) -> DataFrame:
    """Keep a string only when every barcode that reaches it has one cell
    value. An exact whitelist barcode is removed too when another barcode
    with another cell reaches it."""
    keys = _sample_keys(expanded)
    return (
        expanded.groupBy(*keys, "seq")
        .agg(F.count_distinct("cell").alias("n_cells"), F.min("cell").alias("cell"))
        .filter(F.col("n_cells") == 1)
        .select(*keys, "seq", "cell")
    )


def barcode_dictionary(whitelist: DataFrame, hd: int) -> DataFrame:
    """Lookup table seq -> cell after expansion and ambiguity removal."""
    return resolve_ambiguous(expand_whitelist(whitelist, hd))


def split_reads(pairs: DataFrame, bc_read: str = "R1", bio_read: str = "R2", len_cbc: int = 6,
                len_umi: int = 6, umi_first: bool = True) -> DataFrame:
    """Paired reads -> barcode parts plus the biological read.

    ``pairs`` columns: [sample,] rec_no, r1_name, r1_seq, r1_plus, r1_qual,
    r2_name, r2_seq, r2_plus, r2_qual. The barcode read loses its leading
    len_umi + len_cbc bases (seq and qual); this matters only when the same
    read is also the biological read. The plus line keeps its first char.
    """
    b = bc_read.lower()
    o = bio_read.lower()
    bcseq, umi, cbc = split_barcode(f"{b}_seq", len_cbc, len_umi, umi_first)
    n = len_umi + len_cbc
    seq = strip_prefix(f"{o}_seq", n) if o == b else F.col(f"{o}_seq")
    qual = strip_prefix(f"{o}_qual", n) if o == b else F.col(f"{o}_qual")
    return pairs.select(
        *_sample_keys(pairs), "rec_no",
        F.col(f"{o}_name").alias("name"),
        bcseq.alias("bcseq"), umi.alias("umi"), cbc.alias("cbc"),
        seq.alias("seq"), F.substr(F.col(f"{o}_plus"), F.lit(1), F.lit(1)).alias("plus"), qual.alias("qual"),
    )


def assign_cells(reads: DataFrame, dictionary: DataFrame, how: str = "inner",
                 broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Equi-join of read barcodes (``cbc``) with the dictionary (``seq``).

    The dictionary is broadcast after its size is measured; otherwise both
    sides are shuffled on the barcode (AQE splits a hot barcode). ``how`` =
    ``left`` keeps unmatched reads with a null cell (for statistics).
    """
    keys = [k for k in _sample_keys(dictionary) if k in reads.columns]
    d = dictionary.filter(F.col("cell") != NO_CELL).select(*keys, F.col("seq").alias("cbc"), "cell")
    return reads.join(broadcast_if_small(d, broadcast_max_bytes, materialize=True), [*keys, "cbc"], how)


def barcoded_records(assigned: DataFrame) -> DataFrame:
    """FASTQ records of matched reads, named ``name:bcseq:umi:cbc:cell``."""
    return assigned.filter(F.col("cell").isNotNull()).select(
        *_sample_keys(assigned), "rec_no",
        compose_name("name", "bcseq", "umi", "cbc", "cell").alias("name"), "seq", "plus", "qual",
    )


def read_stats(assigned_left: DataFrame) -> DataFrame:
    """Per sample: paired reads, reads with a cell, and their ratio."""
    keys = _sample_keys(assigned_left)
    return assigned_left.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_reads"),
        F.count("cell").alias("n_matched"),
    ).withColumn("frac", F.col("n_matched").cast("double") / F.nullif(F.col("n_reads"), F.lit(0)).cast("double"))


def check_whitelist(whitelist: DataFrame, len_cbc: int) -> DataFrame:
    """Whitelist rows whose barcode length differs from len_cbc."""
    return whitelist.filter(F.length("cbc") != len_cbc).select("*", F.length("cbc").alias("len"))


def pair_reads(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Positional join of two record tables on (sample, rec_no); stops at the
    shorter input like a zip. Columns are prefixed r1_ / r2_."""
    keys = [k for k in ("sample", "rec_no") if k in r1.columns and k in r2.columns]
    a = r1.select(*keys, *[F.col(c).alias(f"r1_{c}") for c in ("name", "seq", "plus", "qual")])
    b = r2.select(*keys, *[F.col(c).alias(f"r2_{c}") for c in ("name", "seq", "plus", "qual")])
    return a.join(b, keys, "inner")


def check_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs that break the input rules: names differ, first characters of
    the plus lines differ, or a quality length differs from its sequence."""
    bad_name = F.col("r1_name") != F.col("r2_name")
    bad_plus = F.substr("r1_plus", F.lit(1), F.lit(1)) != F.substr("r2_plus", F.lit(1), F.lit(1))
    bad_len = (F.length("r1_qual") != F.length("r1_seq")) | (F.length("r2_qual") != F.length("r2_seq"))
    return pairs.select(
        *_sample_keys(pairs), "rec_no", bad_name.alias("bad_name"), bad_plus.alias("bad_plus"),
        bad_len.alias("bad_length"),
    ).filter(F.col("bad_name") | F.col("bad_plus") | F.col("bad_length"))


def checked_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` whose scan stops at the first pair that breaks the input rules
    and names it; the test rides along with whatever reads the pairs. Records
    without a mate (the longer file's end) are not tested."""
    rules = [
        (F.col("r1_name") != F.col("r2_name"), "names differ"),
        (F.substr("r1_plus", F.lit(1), F.lit(1)) != F.substr("r2_plus", F.lit(1), F.lit(1)), "plus lines differ"),
        ((F.length("r1_qual") != F.length("r1_seq")) | (F.length("r2_qual") != F.length("r2_seq")), "a quality is not as long as its sequence"),
    ]
    mated = F.col("r1_name").isNotNull() & F.col("r2_name").isNotNull()
    where = F.concat(F.lit("sample "), F.col("sample"), F.lit(", record "), F.col("rec_no").cast("string"), F.lit(" ("), F.col("r1_name"), F.lit("): "))
    keep = F.lit(True)
    for broken, what in rules:
        keep = F.when(mated & broken, F.raise_error(F.concat(where, F.lit(what))).cast("boolean")).otherwise(keep)
    return pairs.filter(keep)


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise when a check query returns any row, and name the first."""
    row = violations.first()
    if row is not None:
        raise ValueError(f"input check failed: {what}: {row.asDict()}")
