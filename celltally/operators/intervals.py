"""Interval operators: alignment blocks, overlap join, islands, mutual
interval anti-join.

All joins on positions are binned equi-joins on (chrom[, strand], bin) with
the overlap test as a residual predicate, so no task compares every interval
of a contig with every other one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.functions.cigar import alignment_blocks, strand_of
from celltally.operators.common import DEFAULT_BROADCAST_BYTES, bins, broadcast_if_small, first_bin, land, table_bytes
from celltally.operators.sweep import sweep_join

# overlap join: bin widths are DEFAULT_BIN * BIN_STEP ** level; a feature lies in
# the lowest level that is as wide as it is long
DEFAULT_BIN, BIN_STEP, BIN_LEVELS = 256, 8, 8
# anti-join: intervals are clipped read blocks (short), so small bins keep the
# per-bin window small even at a locus with extreme depth
ANTI_BIN = 1_000
# intervals of a task that gives the verdict, about. Their exchange compresses well, so
# partitions coalesced by its bytes hold millions of them, and the window's sort spills
VERDICT_ROWS = 250_000
UNIQUE_MAPQ = 255  # MAPQ the aligner gives to uniquely mapped reads
OVERLAP_COLS = ["sample", "label", "chrom", "start", "end", "qname", "strand", "gene_fullname"]
INTERVAL_KEYS = ["sample", "label", "chrom", "start", "end"]


def align_blocks(aln: DataFrame) -> DataFrame:
    """Alignment rows -> one row per reference block (BED6-like).

    Input columns: sample, rname, pos (1-based), mapq, flag, cigar, qname.
    Output: sample, chrom, start, end (0-based half-open), qname, mapq,
    strand. Unmapped rows (flag 0x4) give no block.
    """
    return aln.filter(F.col("flag").bitwiseAND(4) == 0).select(
        "sample",
        F.col("rname").alias("chrom"),
        F.inline(alignment_blocks("pos", "cigar")),
        "qname",
        "mapq",
        strand_of("flag").alias("strand"),
    )


def label_features(exons: DataFrame | None = None, introns: DataFrame | None = None) -> DataFrame:
    """Feature tables (chr, start, end, strand, gene_fullname) united with a
    ``label`` column, so one overlap join serves both."""
    parts = []
    for label, df in (("intron", introns), ("exon", exons)):
        if df is not None:
            parts.append(df.select("chr", "start", "end", "strand", "gene_fullname", F.lit(label).alias("label")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def overlap_join(
    blocks: DataFrame,
    features: DataFrame,
    bin_size: int = DEFAULT_BIN,
    broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Strand-aware overlap join, each hit clipped to the intersection.

    ``blocks``: sample, chrom, start, end, qname, strand (already filtered).
    ``features``: chr, start, end, strand, gene_fullname[, label].
    One output row per (block, feature) pair with
    ``block.start < feature.end and feature.start < block.end`` on the same
    chrom and strand.

    Bins come in levels of growing width. A feature lies in the lowest level
    that is at least as wide as it is long, so it touches two bins there at
    most; a block probes the levels that have features. Neither side explodes,
    whether exons of a hundred bases or introns of a megabase. A pair counts in
    the first bin both touch. The feature side is broadcast when it has at most
    ``broadcast_max_bytes``; beyond, both sides are dealt by ranges of the genome
    (``sweep.sweep_join``). With None the planner chooses for the binned form.
    """
    f = land(binned_features(features, bin_size), "features")
    if broadcast_max_bytes and table_bytes(f) > broadcast_max_bytes:
        return sweep_join(blocks, features)
    return binned_join(blocks, f, bin_size, bool(broadcast_max_bytes))


def binned_features(features: DataFrame, bin_size: int = DEFAULT_BIN) -> DataFrame:
    """A feature's copies, one per bin it touches in its level."""
    has_label = "label" in features.columns
    widths = [bin_size * BIN_STEP ** i for i in range(BIN_LEVELS)]
    length = F.col("f_end") - F.col("f_start")
    level = F.lit(BIN_LEVELS - 1)
    for i in reversed(range(BIN_LEVELS - 1)):
        level = F.when(length <= widths[i], F.lit(i)).otherwise(level)
    width = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), F.col("f_level") + 1)
    f = features.select(
        F.col("chr").alias("f_chrom"),
        F.col("start").alias("f_start"),
        F.col("end").alias("f_end"),
        F.col("strand").alias("f_strand"),
        "gene_fullname",
        (F.col("label") if has_label else F.lit(None).cast("string")).alias("label"),
    ).withColumn("f_level", level).withColumn("f_width", width)
    last = F.greatest(F.col("f_end"), F.col("f_start") + 1) - 1
    return f.withColumn("f_bin", F.explode(F.sequence(
        F.floor(F.col("f_start") / F.col("f_width")).cast("long"), F.floor(last / F.col("f_width")).cast("long"))))


def binned_join(blocks: DataFrame, f: DataFrame, bin_size: int = DEFAULT_BIN, broadcast: bool = True) -> DataFrame:
    """:func:`overlap_join` with :func:`binned_features`."""
    widths = [bin_size * BIN_STEP ** i for i in range(BIN_LEVELS)]
    present = sorted(r.f_level for r in f.select("f_level").distinct().collect())  # BIN_LEVELS numbers at most
    if broadcast:
        f = F.broadcast(f)

    def at(level):
        return F.transform(bins("start", "end", widths[level]), lambda x: F.struct(F.lit(level).alias("level"), x.alias("bin")))

    probe = [at(i) for i in present]
    probes = F.flatten(F.array(*probe)) if probe else F.array().cast("array<struct<level: int, bin: bigint>>")
    b = blocks.select("sample", "chrom", "start", "end", "qname", "strand", F.inline(probes))
    cond = (
        (b["chrom"] == f["f_chrom"])
        & (b["strand"] == f["f_strand"])
        & (b["level"] == f["f_level"])
        & (b["bin"] == f["f_bin"])
        & (b["start"] < f["f_end"])
        & (f["f_start"] < b["end"])
    )
    first = F.floor(F.greatest(F.col("start"), F.col("f_start")) / F.col("f_width")).cast("long")
    return b.join(f, cond, "inner").filter(F.col("bin") == first).select(
        "sample",
        "label",
        "chrom",
        F.greatest("start", "f_start").alias("start"),
        F.least("end", "f_end").alias("end"),
        "qname",
        "strand",
        "gene_fullname",
    )


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end",
                    merge_touching: bool = True) -> DataFrame:
    """Union of half-open intervals per key: overlapping (and, by default,
    touching) intervals become one island. Output: keys, start, end.

    Gaps and islands: an interval opens a new island when it starts after
    the largest end seen so far in its key (ordered by start, end).
    """
    w = Window.partitionBy(*keys).orderBy(start, end)
    prev_end = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = prev_end.isNull() | ((F.col(start) > prev_end) if merge_touching else (F.col(start) >= prev_end))
    islands = (
        df.select(*keys, start, end)
        .withColumn("_open", F.when(opens, 1).otherwise(0))
        .withColumn("_island", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return islands.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def blocked_intervals(intervals: DataFrame, bin_size: int = ANTI_BIN,
                      labels: tuple[str, str] = ("intron", "exon"), carry: tuple[str, ...] = (),
                      n: int | None = None) -> DataFrame:
    """(sample, label, chrom, start, end[, ``carry``]) that overlap at least one interval
    of the other label in the same sample and chrom (any strand, any gene,
    any read); an interval may repeat (once per bin it is blocked in).

    An interval a meets the other label iff the largest end among that
    label's intervals starting before a.end exceeds a.start. Intervals are
    cut into every bin they touch (one exchange on (sample, chrom, bin));
    inside a bin each interval enters a single window twice, as a source
    ordered by its start and as a probe ordered by its end (probes first on
    ties, since touching is not overlapping); running maxima of the source
    ends per label give the verdict. Any overlap has a point in a bin both
    intervals touch, so the test inside bins is exact. A bin holds only the
    distinct intervals touching it, however many reads pile up there.

    ``n``: how many intervals there are, about; tasks then get ``VERDICT_ROWS``
    of them. Without it the session's settings deal them out.
    """
    first, second = labels
    keys = [*INTERVAL_KEYS, *carry]
    iv = intervals.select(*keys)
    binned = iv.select("*", F.posexplode(bins("start", "end", bin_size)).alias("_step", "_bin"))
    # the window's only exchange, before each interval becomes two rows; what repeats moves in
    # place of what does not: the length for the end, and how far the bin is from the first
    moved = binned.select(*[c for c in keys if c != "end"], (F.col("end") - F.col("start")).alias("_length"), "_step")
    bin_ = first_bin("start", bin_size) + F.col("_step")
    parts = [] if n is None else [max(iv.sparkSession.sparkContext.defaultParallelism, -(-n // VERDICT_ROWS))]
    moved = moved.repartition(*parts, "sample", "chrom", bin_)
    binned = moved.select("*", (F.col("start") + F.col("_length")).alias("end"), bin_.alias("bin"))
    roles = binned.select(
        *keys, "bin",
        F.inline(F.array(
            F.struct(F.col("start").alias("key"), F.lit(1).alias("src")),
            F.struct(F.col("end").alias("key"), F.lit(0).alias("src")),
        )),
    )
    w = Window.partitionBy("sample", "chrom", "bin").orderBy("key", "src").rowsBetween(Window.unboundedPreceding, 0)

    def source_max(label):
        return F.max(F.when((F.col("src") == 1) & (F.col("label") == label), F.col("end"))).over(w)

    verdict = roles.select(
        *keys, "src",
        F.when(F.col("label") == first, source_max(second))
        .when(F.col("label") == second, source_max(first)).alias("other_max_end"),
    )
    hit = verdict.filter((F.col("src") == 0) & (F.col("other_max_end") > F.col("start")))
    # an interval spanning several bins may appear more than once; the result
    # only feeds semi/anti joins, where repeats change nothing
    return hit.select(*keys)


def clean_overlaps(overlaps: DataFrame, bin_size: int = ANTI_BIN, dedup: bool = True) -> dict[str, DataFrame]:
    """Mutual interval anti-join of labelled overlap rows.

    An intron row is dropped when its interval meets any exon row's interval
    of the same sample and chrom, and an exon row when it meets any intron
    row's interval (both tested against the uncleaned other side). Equal
    rows are first reduced to one (``dedup``).

    Returns ``{"overlaps": deduplicated rows, "blocked": blocked intervals,
    "clean": kept rows}``. Plan: the dedup shuffle (hashed on all columns,
    so it spreads evenly) feeds both branches; the verdict is computed once
    per distinct interval; the final anti-join is a shuffle join on the
    interval, where AQE splits hot intervals. :func:`drop_blocked` applies
    the verdict to any narrower projection of the rows.
    """
    rows = overlaps.select(*OVERLAP_COLS)
    if dedup:
        rows = rows.dropDuplicates(OVERLAP_COLS)
    intervals = rows.select(*INTERVAL_KEYS).distinct()
    blocked = blocked_intervals(intervals, bin_size)
    return {"overlaps": rows, "blocked": blocked, "clean": drop_blocked(rows, blocked)}


def drop_blocked(rows: DataFrame, blocked: DataFrame) -> DataFrame:
    """Rows whose (sample, label, chrom, start, end) is not blocked."""
    return rows.join(blocked, INTERVAL_KEYS, "left_anti").select(*rows.columns)


def contig_filter(rows: DataFrame, contigs: DataFrame,
                  broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                  column: str = "chrom") -> DataFrame:
    """Keep rows whose chrom is a listed contig (per sample when ``contigs``
    has a ``sample`` column)."""
    keys = ["sample", column] if "sample" in contigs.columns else [column]
    c = contigs.select(*(k for k in keys if k != column), F.col("contig").alias(column)).distinct()
    return rows.join(broadcast_if_small(c, broadcast_max_bytes, materialize=True), keys, "left_semi")
