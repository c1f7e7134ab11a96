"""The three steps of a run over all samples. Plans are lazy but for lookup
tables and collapsed overlap rows, which are written once when needed.

* :func:`annotate` - GTF rows -> gene, exon and intron tables.
* :func:`barcode` - paired reads + whitelist -> barcoded reads + statistics.
* :func:`count` - alignments + feature tables -> cleaned overlap rows,
  molecules and all count measures.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.functions.barcodes import parse_name
from celltally.functions.counting import gene_key
from celltally.operators import annotation as ann
from celltally.operators import barcodes as bc
from celltally.operators import counts as cnt
from celltally.operators import intervals as iv
from celltally.operators.common import DEFAULT_BROADCAST_BYTES, land, table_bytes
from celltally.operators.nearest import observed_dictionary
from celltally.operators.sweep import Sweep
from celltally.plans.layout import ROWS_PER_BUCKET, IntervalTable


@dataclass
class Annotation:
    genes: DataFrame
    exons: DataFrame
    introns: DataFrame


def annotate(gtf: DataFrame) -> Annotation:
    exons, introns = ann.exon_intron_tables(gtf)
    return Annotation(genes=ann.gene_table(gtf), exons=exons, introns=introns)


@dataclass
class BarcodeParams:
    bc_read: str = "R1"
    bio_read: str = "R2"
    len_cbc: int = 6
    len_umi: int = 6
    umi_first: bool = True
    hd: int = 0


#: From this distance on, barcodes that reads hold are looked up in the whitelist
#: by an index, in place of writing out all strings near a whitelist entry.
INDEX_HD = 2


@dataclass
class Barcoded:
    dictionary: DataFrame  # from INDEX_HD on: of the observed barcodes only
    assigned: DataFrame  # every pair, cell null when unmatched
    records: DataFrame  # matched reads as FASTQ records
    stats: DataFrame


def barcode(pairs: DataFrame, whitelist: DataFrame, params: BarcodeParams | None = None,
            broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> Barcoded:
    p = params or BarcodeParams()
    reads = bc.split_reads(pairs, p.bc_read, p.bio_read, p.len_cbc, p.len_umi, p.umi_first)
    dictionary = bc.barcode_dictionary(whitelist, p.hd) if p.hd < INDEX_HD else observed_dictionary(reads, whitelist, p.hd)
    assigned = bc.assign_cells(reads, dictionary, how="left", broadcast_max_bytes=broadcast_max_bytes)
    return Barcoded(dictionary, assigned, bc.barcoded_records(assigned), bc.read_stats(assigned))


class Counted:
    """Results of the count step, each built when first asked for.

    ``blocks``; ``overlaps`` (labelled overlap rows, repeats removed); ``clean``
    (after the mutual anti-join); ``molecules``; ``counts`` (one row per
    (sample, cell, gene), nine measures). ``overlaps`` and ``clean`` keep read
    names. ``molecules`` and ``counts`` come from rows collapsed per interval
    and molecule, written once to the shared folder: the alignments are
    scanned and joined once, and the verdict reads the same table.
    """

    def __init__(self, blocks: DataFrame, raw: DataFrame, umi_length: int, anti_bin_size: int, dedup: bool):
        self.blocks = blocks
        self._raw, self._umi_length, self._bin, self._dedup = raw, umi_length, anti_bin_size, dedup

    @cached_property
    def overlaps(self) -> DataFrame:
        return self._raw.dropDuplicates(iv.OVERLAP_COLS) if self._dedup else self._raw

    @cached_property
    def clean(self) -> DataFrame:
        return iv.clean_overlaps(self._raw, self._bin, self._dedup)["clean"]

    @cached_property
    def molecules(self) -> DataFrame:
        rows = land(cnt.collapsed_rows(self._raw, self._dedup), "collapsed")
        blocked = iv.blocked_intervals(rows.select(*iv.INTERVAL_KEYS).distinct(), self._bin, n=rows.count())
        return cnt.molecules(iv.drop_blocked(rows, blocked))

    def table(self, n_buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> IntervalTable:
        """The overlap rows written once, bucketed by interval, for a run that
        needs the rows and the counts."""
        return IntervalTable(self._raw, self.blocks, n_buckets, rows_per_bucket, self._bin, self._dedup)

    @cached_property
    def counts(self) -> DataFrame:
        return cnt.gene_cell_counts(self.molecules, self._umi_length)


class SweptCounted(Counted):
    """The same where both sides of the overlap join are large. Repeats and
    blocked intervals are left out where the rows are made (``sweep.Sweep``):
    the verdict comes first, from the blocks' places alone, and rows with read
    names are exchanged once, as blocks. For ``molecules`` and ``counts`` a block
    takes its cell, its UMI and 128 bits of the name along, not the name; rows are
    counted where they are made, and what is left is exchanged once for both."""

    def __init__(self, blocks: DataFrame, unique: DataFrame, features: DataFrame, umi_length: int, anti_bin_size: int, dedup: bool):
        self.blocks = blocks
        self._unique, self._features = unique, features
        self._umi_length, self._bin, self._dedup = umi_length, anti_bin_size, dedup

    @cached_property
    def _sweep(self) -> Sweep:
        return Sweep(self._unique, self._features)

    @cached_property
    def _raw(self) -> DataFrame:
        return self._sweep.rows()

    @cached_property
    def overlaps(self) -> DataFrame:
        return self._sweep.rows(distinct=self._dedup)

    @cached_property
    def _blocked(self) -> DataFrame:
        return land(iv.blocked_intervals(self._sweep.intervals(), self._bin, n=self._sweep.n_blocks).distinct(), "blocked")

    @cached_property
    def clean(self) -> DataFrame:
        return self._sweep.rows(distinct=self._dedup, blocked=self._blocked)

    @cached_property
    def molecules(self) -> DataFrame:
        umi, cell = parse_name("qname")
        reads = self._sweep.blocks.select("sample", "chrom", "strand", "start", "end", F.unhex(F.md5("qname")).alias("read"), cell.alias("cell"), umi.alias("umi"))
        rows = self._sweep.carrying(reads, "read binary, cell string, umi string").tallies(
            ["sample", "label", "chrom", "gene_fullname", "cell", "umi"], distinct=self._dedup, blocked=self._blocked)
        rows = rows.select("sample", "label", "cell", gene_key("gene_fullname", "chrom").alias("gene"), "umi", "n")
        return cnt.molecules(rows.repartition("sample", "cell", "gene"))


def count(alignments: DataFrame, exons: DataFrame, introns: DataFrame, contigs: DataFrame | None = None,
          umi_length: int = cnt.DEFAULT_UMI_LENGTH, bin_size: int = iv.DEFAULT_BIN,
          anti_bin_size: int = iv.ANTI_BIN, dedup: bool = True,
          broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> Counted:
    """Alignments (sample, rname, pos, mapq, flag, cigar, qname) -> counts.

    The contig list filters the alignments themselves: overlaps and the
    anti-join never cross contigs, so nothing off the list is joined at all.
    """
    if contigs is not None:
        alignments = iv.contig_filter(alignments, contigs, broadcast_max_bytes, column="rname")
    blocks = iv.align_blocks(alignments)
    unique = blocks.filter(F.col("mapq") == iv.UNIQUE_MAPQ)
    features = land(iv.label_features(exons=exons, introns=introns), "features")
    binned = iv.binned_features(features, bin_size)
    if broadcast_max_bytes and table_bytes(binned) > broadcast_max_bytes:
        return SweptCounted(blocks, unique, features, umi_length, anti_bin_size, dedup)
    raw = iv.binned_join(unique, binned, bin_size, bool(broadcast_max_bytes))
    return Counted(blocks, raw, umi_length, anti_bin_size, dedup)
