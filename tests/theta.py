"""Plain quadratic forms of the interval operators, to compare with."""

from pyspark.sql import functions as F

from celltally.operators.intervals import OVERLAP_COLS


def overlap_join(blocks, features):
    f = features.select(
        F.col("chr").alias("f_chrom"), F.col("start").alias("f_start"), F.col("end").alias("f_end"), F.col("strand").alias("f_strand"),
        "gene_fullname", (F.col("label") if "label" in features.columns else F.lit(None).cast("string")).alias("label"))
    j = blocks.join(f, (blocks["chrom"] == f["f_chrom"]) & (blocks["strand"] == f["f_strand"])
                    & (blocks["start"] < f["f_end"]) & (f["f_start"] < blocks["end"]))
    return j.select("sample", "label", "chrom", F.greatest("start", "f_start").alias("start"), F.least("end", "f_end").alias("end"),
                    "qname", "strand", "gene_fullname")


def clean_overlaps(overlaps):
    rows = overlaps.select(*OVERLAP_COLS).dropDuplicates(OVERLAP_COLS)
    other = rows.select(*[F.col(c).alias(f"o_{c}") for c in ("sample", "label", "chrom", "start", "end")]).distinct()
    return rows.join(other, (rows["sample"] == other["o_sample"]) & (rows["chrom"] == other["o_chrom"]) & (rows["label"] != other["o_label"])
                     & (rows["start"] < other["o_end"]) & (other["o_start"] < rows["end"]), "left_anti")
