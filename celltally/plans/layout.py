"""Overlap rows in one layout for repeats, verdict and counts.

The rows are exchanged once, by interval and salt, and written as a table
bucketed and sorted that way. Repeated rows, the distinct intervals, and the
anti-join with the blocked ones then need no further exchange of rows: Spark
reads the buckets as they lie. What still moves is one row per distinct
interval (for the verdict) and per molecule and interval (for the counts).

Where a sample has more blocks in a stretch of the genome than a bucket should
hold, the salt deals the reads there over several buckets; elsewhere it is 0.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.functions.barcodes import parse_name
from celltally.functions.counting import gene_key
from celltally.operators import counts as cnt
from celltally.operators import intervals as iv
from celltally.operators.common import bins, broadcast_if_small, land
from celltally.session import scratch_path

KEYS = [*iv.INTERVAL_KEYS, "salt"]
#: Bases of a stretch whose blocks are counted; blocks of a stretch that one bucket may hold.
STRETCH, ROWS_PER_BUCKET = 4096, 2_000_000


def hot_stretches(blocks: DataFrame, rows_per_bucket: int) -> DataFrame:
    """(sample, chrom, stretch, splits) of stretches with too many blocks for a bucket."""
    touched = blocks.select("sample", "chrom", F.explode(bins("start", "end", STRETCH)).alias("stretch"))
    n = touched.groupBy("sample", "chrom", "stretch").agg(F.count("*").alias("n"))
    return n.where(F.col("n") > rows_per_bucket).select("sample", "chrom", "stretch", F.ceil(F.col("n") / rows_per_bucket).alias("splits"))


class IntervalTable:
    """Labelled overlap rows (see ``intervals.overlap_join``), repeats removed.

    ``rows``: the bucketed table; ``clean``: after the mutual anti-join;
    ``molecules``. ``drop`` removes the table from the catalog; its files lie
    among the scratch tables.
    """

    def __init__(self, raw: DataFrame, blocks: DataFrame, n_buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
                 anti_bin_size: int = iv.ANTI_BIN, dedup: bool = True):
        self.spark, self.name = raw.sparkSession, f"celltally_intervals_{uuid.uuid4().hex[:12]}"
        n = n_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        hot = broadcast_if_small(hot_stretches(blocks, rows_per_bucket), materialize=True)
        at = raw.select(*iv.OVERLAP_COLS).withColumn("stretch", F.floor(F.col("start") / STRETCH)).join(hot, ["sample", "chrom", "stretch"], "left")
        salted = at.select(*iv.OVERLAP_COLS, F.coalesce(F.pmod(F.xxhash64("qname"), "splits"), F.lit(0)).cast("int").alias("salt"))
        salted = salted.repartition(n, *KEYS)
        if dedup:
            salted = salted.dropDuplicates([*iv.OVERLAP_COLS, "salt"])
        salted.write.format("parquet").option("compression", "zstd").bucketBy(n, *KEYS).sortBy(*KEYS).option("path", scratch_path(self.spark, "intervals")).saveAsTable(self.name)
        self.rows = self.spark.table(self.name)
        pieces = land(self.rows.select(*KEYS).distinct(), "interval-pieces")
        self.blocked = land(iv.blocked_intervals(pieces, anti_bin_size, carry=("salt",), n=pieces.count()).distinct(), "blocked-pieces")

    @property
    def clean(self) -> DataFrame:
        return self.rows.join(self.blocked, KEYS, "left_anti").select(*iv.OVERLAP_COLS)

    @property
    def molecules(self) -> DataFrame:
        """Copies of a molecule on one interval are counted where they lie; what
        is left moves once, to its cell and gene, for the counts too."""
        umi, cell = parse_name("qname")
        rows = self.rows.join(self.blocked, KEYS, "left_anti").select(*KEYS, cell.alias("cell"), gene_key("gene_fullname", "chrom").alias("gene"), umi.alias("umi"))
        lying = rows.groupBy(*KEYS, "cell", "gene", "umi").agg(F.count(F.lit(1)).alias("n"))
        return cnt.molecules(lying.select("sample", "label", "cell", "gene", "umi", "n").repartition("sample", "cell", "gene"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
