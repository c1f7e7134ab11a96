"""Overlap join of two large sides by ranges of the genome.

Blocks are counted in the bins they touch; consecutive bins make up slots of
about ``rows_per_slot`` blocks, and a bin with more than that is several slots,
its blocks dealt by read. A feature is copied to every slot with blocks that
may reach it, over the borders of ranges too. A slot is one task: it holds its
features sorted by start, in classes of length, and its blocks stream past them.
So both sides cross the network once, no locus is one task's work, and a task
holds the features of its range only.

Rows without repeats, or without blocked intervals, need no further exchange of
rows: a block then goes to every bin it touches and gives there the rows that
start in the bin. Equal rows have one read and one start, so they meet in one
task, and so do they and the blocked interval of that start.

A row takes to its slot what the caller asks for: the read's name, other columns
that stand for the read, or none; counts of rows leave the slot in place of rows.
Rows move with their length in place of their end: lengths repeat, ends do not, so
compression leaves little of them.
"""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.operators.common import bins as touched_bins
from celltally.operators.common import broadcast_if_small, land

#: Blocks of a slot, about.
ROWS_PER_SLOT = 500_000
#: Bins of the longest contig, at most; least width of a bin.
BINS, LEAST_BIN = 16_384, 2_048
#: Candidate pairs verified at a time in a task.
PAIRS = 1 << 20
#: A feature's class: how often its length can be divided by this.
CLASS_STEP = 8

#: Rows whose copies are counted at a time in a task.
HELD = 1 << 18

INTERVAL = "sample string, label string, chrom string, start long, end long"
READ, GENE = "qname string", "gene_fullname string"


def slots_of_bins(blocks: DataFrame, width: int, rows_per_slot: int) -> DataFrame:
    """(chrom, strand, bin, slot, splits, before): the first slot of each bin with
    blocks, over how many its blocks are dealt, and the bin of the same contig and
    strand that comes before it in the slot. The tables' rows are bins, at most
    ``BINS`` a contig and strand, not blocks."""
    touched = blocks.select("chrom", "strand", F.explode(touched_bins("start", "end", width)).alias("bin"))
    counted = land(touched.groupBy("chrom", "strand", "bin").agg(F.count("*").alias("n")), "sweep-bins")
    order = Window.orderBy("chrom", "strand", "bin")
    hot = F.col("n") > rows_per_slot
    upto = lambda c: F.coalesce(F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = counted.select("*", hot.alias("hot"), upto(hot.cast("long")).alias("hot_before"), upto(F.when(hot, 0).otherwise(F.col("n"))).alias("rows_before"))
    group = F.struct("hot_before", "hot", F.when(F.col("hot"), F.lit(0)).otherwise(F.floor(F.col("rows_before") / rows_per_slot)).alias("part"))
    groups = groups.select("*", group.alias("group"), F.when(F.col("hot"), F.ceil(F.col("n") / rows_per_slot)).otherwise(1).alias("splits"))
    opens = groups.select("*", (~F.col("group").eqNullSafe(F.lag("group").over(order))).cast("long").alias("opens"))
    last = F.sum(F.col("opens") * F.col("splits")).over(order)
    follows = (F.col("opens") == 0) & (F.lag("chrom").over(order) == F.col("chrom")) & (F.lag("strand").over(order) == F.col("strand"))
    return opens.select("chrom", "strand", "bin", (last - F.col("splits")).cast("int").alias("slot"), F.col("splits").cast("int").alias("splits"),
                        F.when(follows, F.lag("bin").over(order)).alias("before"))


class Sweep:
    """The join of ``blocks`` and ``features`` (see ``intervals.overlap_join``).

    Slots are made once, from the blocks' places, which are written for it.
    Rows with a null contig, strand or place overlap nothing.
    """

    def __init__(self, blocks: DataFrame, features: DataFrame, rows_per_slot: int | None = None):
        known = lambda df, c: df.where(f"{c} IS NOT NULL AND strand IS NOT NULL AND start IS NOT NULL AND `end` IS NOT NULL")
        self.blocks, self.features = known(blocks, "chrom"), known(features, "chr")
        place = ["sample", "chrom", "strand", "start"]
        places = land(self.blocks.select(*place, (F.col("end") - F.col("start")).alias("length")), "sweep-places")
        self.places = places.select(*place, (F.col("start") + F.col("length")).alias("end"))
        far, longest, self.n_blocks = self.places.agg(F.max("start"), F.max(F.col("end") - F.col("start")), F.count("*")).first()
        self.longest = longest or 0
        self.width = max(LEAST_BIN, -(-((far or 0) + 1) // BINS))
        slots = land(slots_of_bins(self.places, self.width, rows_per_slot or ROWS_PER_SLOT), "sweep-slots")
        self.n_slots = slots.agg(F.max(F.col("slot") + F.col("splits"))).first()[0] or 1
        self.lookup = broadcast_if_small(slots)
        self.read, self.gene = READ, GENE

    def carrying(self, blocks: DataFrame, read: str, gene: bool = True) -> Sweep:
        """The same join in the same slots for ``blocks`` with the columns ``read``
        (DDL, may be empty) in place of the read's name; rows are equal if these are."""
        out = copy.copy(self)
        out.blocks, out.read, out.gene = blocks, read, GENE if gene else ""
        return out

    @property
    def result(self) -> str:
        return ", ".join(x for x in (INTERVAL, self.read, "strand string", self.gene) if x)

    def _row(self, df: DataFrame, kind: int, slot, touched: bool) -> DataFrame:
        """A row of a slot, ``length`` in place of its end; columns that ``df`` lacks are null."""
        df = df.withColumn("length", F.col("end") - F.col("start"))
        cols = [(F.col(c) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in
                (x.split() for x in (self.result.replace("end long", "length long") + ", step int" * touched).split(", "))]
        return df.select(slot.cast("int").alias("slot"), F.lit(kind).alias("kind"), *cols)

    def _everywhere(self, df: DataFrame, kind: int, touched: bool) -> DataFrame:
        """``df`` (with slot and splits) in all slots of its bins."""
        return self._row(df.withColumn("slot", F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("splits") - 1))), kind, F.col("slot"), touched)

    def dealt(self, touched: bool = False, blocked: DataFrame | None = None) -> DataFrame:
        """Blocks (kind 1), copies of features (kind 0) and of blocked intervals
        (kind -1), one slot to a partition, a contig and strand's blocks last.
        With ``touched`` a block is in the slots of all bins it touches, else of
        the one it starts in."""
        on = ["chrom", "strand", "bin"]
        left = self.blocks.withColumn("bin", F.floor(F.col("start") / self.width))
        if touched:  # of the bin a block keeps how far it is from the first: mostly 0, so it takes no room
            left = self.blocks.select("*", F.posexplode(touched_bins("start", "end", self.width)).alias("step", "bin"))
        read = [x.split()[0] for x in self.read.split(", ") if x]
        read = F.xxhash64(*read) if touched else F.xxhash64(*read, "start")
        both = self._row(left.join(self.lookup, on), 1, F.col("slot") + F.pmod(read, "splits"), touched)
        first = F.floor((F.col("start") - (0 if touched else self.longest)) / self.width)
        last = F.floor((F.greatest(F.col("end"), F.col("start") + 1) - 1) / self.width)
        right = self.features.withColumnRenamed("chr", "chrom").withColumn("first_bin", F.greatest(first, F.lit(0)))
        right = right.withColumn("bin", F.explode(F.sequence(F.col("first_bin"), F.greatest(last, F.lit(0))))).join(self.lookup, on)
        # a feature meets a slot once, at the first of the slot's bins that it touches
        both = both.unionByName(self._everywhere(right.where("before IS NULL OR before < first_bin"), 0, touched))
        if blocked is not None:
            at = blocked.withColumn("bin", F.floor(F.col("start") / self.width))
            both = both.unionByName(self._everywhere(at.join(self.lookup, ["chrom", "bin"]), -1, touched))
        return both.repartitionById(self.n_slots, "slot").sortWithinPartitions("chrom", "strand", "kind", "start")

    def rows(self, distinct: bool = False, blocked: DataFrame | None = None) -> DataFrame:
        """Overlap rows; ``distinct``: equal ones once; ``blocked``: without those
        whose (sample, label, chrom, start, end) is among its rows."""
        touched = distinct or blocked is not None
        return _swept(self.dealt(touched, blocked), self.result, distinct, self.width if touched else None)

    def tallies(self, by: list[str], distinct: bool = False, blocked: DataFrame | None = None) -> DataFrame:
        """How many of ``rows`` there are for the columns ``by`` (``n``); counted in the
        slots, so that a key comes once or a few times from each of its slots."""
        touched = distinct or blocked is not None
        return _swept(self.dealt(touched, blocked), self.result, distinct, self.width if touched else None, by)

    def intervals(self) -> DataFrame:
        """(sample, label, chrom, start, end) of all overlap rows, from the places
        alone; most repeats are left out."""
        nameless = self.carrying(self.places, "", gene=False)
        return _swept(nameless.dealt(), nameless.result, True, None).select("sample", "label", "chrom", "start", "end")


def dealt(blocks: DataFrame, features: DataFrame, rows_per_slot: int | None = None) -> DataFrame:
    return Sweep(blocks, features, rows_per_slot).dealt()


def _index(table):
    """Features by class of length: (longest, starts, ends, rows), sorted by start."""
    import numpy as np

    start, end = table.column("start").to_numpy(), table.column("end").to_numpy()
    level = np.floor(np.log(np.maximum(end - start, 1)) / np.log(CLASS_STEP))
    out = []
    for c in np.unique(level):
        rows = np.flatnonzero(level == c)
        rows = rows[np.argsort(start[rows], kind="stable")]
        out.append((int((end - start)[rows].max()), start[rows], end[rows], rows))
    return out


def _met(index, start, end):
    """(block, feature) rows that overlap, some blocks at a time."""
    import numpy as np

    bounds = [(np.searchsorted(s, start - longest, "right"), np.searchsorted(s, end, "left")) for longest, s, _, _ in index]
    todo = np.cumsum(sum((np.maximum(hi - lo, 0) for lo, hi in bounds), np.zeros(len(start), np.int64)))
    begin = 0
    while begin < len(start):
        done = todo[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(todo, done + PAIRS, "right")))
        pairs = []
        for (_, _, ends, rows), (lo, hi) in zip(index, bounds, strict=True):
            n = np.maximum(hi[begin:stop] - lo[begin:stop], 0)
            block = np.repeat(np.arange(begin, stop), n)
            at = np.arange(len(block)) + np.repeat(lo[begin:stop] - (np.cumsum(n) - n), n)
            hit = ends[at] > start[block]
            pairs.append((block[hit], rows[at[hit]]))
        yield tuple(np.concatenate(p) for p in zip(*pairs, strict=True))
        begin = stop


def _unblocked(rows, blocked, starts):
    """``rows`` whose interval is not among the blocked ones, sorted by start."""
    import numpy as np

    at = rows.column("start").to_numpy()
    lo, hi = np.searchsorted(starts, at.min(), "left"), np.searchsorted(starts, at.max(), "right")
    keys = ["sample", "label", "start", "end"]
    return rows.join(blocked.slice(lo, hi - lo), keys, join_type="left anti", use_threads=False) if hi > lo else rows


def _sweep(batches, names, distinct=False, width=None):
    """Overlap rows of a slot, columns ``names``. With ``width`` a block gives the rows that
    start in its bin. With ``distinct``, rows are held until no later block can repeat them."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    place, held, index, blocked, starts, kept = None, [], None, [], None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.append_column("end", pc.add(table.column("start"), table.column("length")))
        keys = list(zip(*(table.column(c).to_pylist() for c in ("chrom", "strand", "kind")), strict=True))
        edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            chrom, strand, kind = keys[a]
            part = table.slice(a, b - a)
            if (chrom, strand) != place:
                if kept is not None:
                    yield from kept.combine_chunks().to_batches()
                place, held, index, blocked, starts, kept = (chrom, strand), [], None, [], None, None
            if kind < 1:
                (held if kind == 0 else blocked).append(part)
                continue
            if not held:
                continue
            if index is None:
                held = [pa.concat_tables(held).combine_chunks()]
                index = _index(held[0])
                if blocked:
                    blocked = pa.concat_tables(blocked).select(["sample", "label", "start", "end"]).combine_chunks()
                    starts = blocked.column("start").to_numpy()
            part = part.combine_chunks()
            start = part.column("start").to_numpy()
            for block, feature in _met(index, start, part.column("end").to_numpy()):
                if not len(block):
                    continue
                x, f = part.take(pa.array(block)), held[0].take(pa.array(feature.astype(np.int64)))
                out = {c: (f if c in ("label", "gene_fullname") else x).column(c) for c in names}
                out |= {"start": pc.max_element_wise(x.column("start"), f.column("start")), "end": pc.min_element_wise(x.column("end"), f.column("end"))}
                out = pa.table(out)
                if width:
                    out = out.filter(pa.array(out.column("start").to_numpy() // width == x.column("start").to_numpy() // width + x.column("step").to_numpy()))
                if starts is not None and len(out):
                    out = _unblocked(out, blocked, starts)
                if distinct:
                    out = pa.concat_tables([out.select(names), *([] if kept is None else [kept])]).group_by(names, use_threads=False).aggregate([]).select(names)
                    done = pc.less(out.column("start"), int(start[block.max()]))
                    out, kept = out.filter(done), out.filter(pc.invert(done))
                yield from out.select(names).combine_chunks().to_batches()
    if kept is not None:
        yield from kept.combine_chunks().to_batches()


def _tally(batches, by):
    """How many rows there are of each ``by``, among ``HELD`` rows or so at a time."""
    import pyarrow as pa

    def counted(held):
        t = pa.Table.from_batches(held).group_by(by, use_threads=False).aggregate([([], "count_all")])
        return t.select([*by, "count_all"]).rename_columns([*by, "n"]).combine_chunks().to_batches()

    held, n = [], 0
    for batch in batches:
        held.append(batch.select(by))
        n += len(batch)
        if n >= HELD:
            yield from counted(held)
            held, n = [], 0
    if held:
        yield from counted(held)


def _swept(slots: DataFrame, result: str, distinct: bool, width: int | None, by: list[str] | None = None) -> DataFrame:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    columns = dict(c.split() for c in result.split(", "))

    def made(batches):
        rows = _sweep(batches, list(columns), distinct, width)
        yield from _tally(rows, by) if by else rows

    return slots.mapInArrow(made, ", ".join([*(f"{c} {columns[c]}" for c in by), "n long"]) if by else result)


def sweep_join(blocks: DataFrame, features: DataFrame, rows_per_slot: int | None = None) -> DataFrame:
    """Same rows as ``intervals.overlap_join``; blocks are read twice, once for their places."""
    return Sweep(blocks, features, rows_per_slot).rows()
