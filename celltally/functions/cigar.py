"""Alignment blocks from CIGAR strings, with higher-order built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_TYPE = "array<struct<start:bigint,end:bigint>>"
# Fixed CIGAR semantics (SAM specification): operations that consume the
# reference and stay inside a block, and the one that splits blocks.
REF_OPS = ["M", "D", "=", "X"]
SPLIT_OP = "N"
CIGAR_OP_PATTERN = r"[0-9]+[MIDNSHP=X]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strand_of(flag) -> Column:
    """'-' when the read is reverse complemented (flag bit 0x10), else '+'."""
    return F.when(_c(flag).bitwiseAND(16) != 0, F.lit("-")).otherwise(F.lit("+"))


def alignment_blocks(pos, cigar) -> Column:
    """0-based half-open reference blocks of one alignment.

    ``pos`` is the 1-based leftmost position. The alignment is cut at every
    ``N`` (skipped region); M, D, = and X extend the current block; I, S, H
    and P do not move on the reference. Empty blocks are dropped.
    """
    ops = F.transform(
        F.regexp_extract_all(_c(cigar), F.lit(CIGAR_OP_PATTERN), 0),
        lambda s: F.struct(
            F.substr(s, F.lit(1), F.length(s) - 1).cast("bigint").alias("n"),
            F.substr(s, F.length(s), F.lit(1)).alias("op"),
        ),
    )
    start0 = (_c(pos) - 1).cast("bigint")
    init = F.struct(
        start0.alias("ref"),
        start0.alias("bstart"),
        F.array().cast(BLOCK_TYPE).alias("blocks"),
    )

    def step(acc, op):
        moved = acc["ref"] + op["n"]
        closed = F.array_append(acc["blocks"], F.struct(acc["bstart"].alias("start"), acc["ref"].alias("end")))
        return (
            F.when(op["op"] == SPLIT_OP, F.struct(moved.alias("ref"), moved.alias("bstart"), closed.alias("blocks")))
            .when(op["op"].isin(*REF_OPS), F.struct(moved.alias("ref"), acc["bstart"].alias("bstart"), acc["blocks"].alias("blocks")))
            .otherwise(acc)
        )

    def finish(acc):
        return F.filter(
            F.array_append(acc["blocks"], F.struct(acc["bstart"].alias("start"), acc["ref"].alias("end"))),
            lambda b: b["end"] > b["start"],
        )

    return F.aggregate(ops, init, step, finish)
