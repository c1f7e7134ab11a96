"""Count-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value of the saturation formula: the count used for x >= K is K minus
# this offset.
SATURATION_OFFSET = 1e-3


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gene_key(gene_fullname, chrom) -> Column:
    """Matrix gene key ``<gene_fullname>__<chrom>`` (trailing blanks cut)."""
    return F.concat_ws("__", F.regexp_replace(_c(gene_fullname), r"\s+$", ""), _c(chrom))


def umi_to_transcripts(x, umi_length: int) -> Column:
    """Expected transcripts behind x distinct UMIs out of K = 4**umi_length.

    x = 0 -> 0; 0 < x < K -> ln(1 - x/K) / ln(1 - 1/K);
    x >= K -> the same with x = K - 0.001. Double, unrounded.
    """
    k = float(4 ** umi_length)
    c = _c(x).cast("double")
    denom = F.ln(F.lit(1.0 - 1.0 / k))
    return (
        F.when(c >= F.lit(k), F.ln(F.lit(1.0 - (k - SATURATION_OFFSET) / k)) / denom)
        .when(c > 0, F.ln(F.lit(1.0) - c / F.lit(k)) / denom)
        .when(c == 0, F.lit(0.0))
    )
