"""Mixing sources to target weights.

Sizes are aggregated per source, repetition rates derived from them, and each
document is emitted ``floor(rate)`` times plus one more time if a number drawn
from its hash is below the fraction of the rate. All of it is DataFrame code;
the driver only sees a handful of totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from celltally.llm.common import WORD, col, fresh, land

#: A source is repeated this many times at most.
MAX_REPEATS = 3
#: Weights by rank of the source, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Measured bytes of the source table up to which it is broadcast.
SOURCES_BROADCAST_BYTES = 8 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, source_size): partial sums before the shuffle, so a source with
    a third of all rows sends one row per task."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``pos``: place of the source by code point, null last, from 0.

    Range partitions are ranked on their own and shifted by the counts of the
    partitions before (one number per partition reaches the driver).
    """
    null_last = F.col("source").isNull()
    parts = land(
        sources.repartitionByRange(null_last, F.col("source")).withColumn("part", F.spark_partition_id()), "mix-parts")
    before, shift = 0, []
    for part, n in sorted((r.part, r.n) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()):
        shift.append((part, before))
        before += n
    place = F.row_number().over(Window.partitionBy("part").orderBy(null_last, F.col("source"))) - 1
    if not shift:
        return parts.withColumn("pos", F.lit(0).cast("long")).drop("part")
    offset = parts.sparkSession.createDataFrame(shift, "part int, shift long")
    return (parts.withColumn("place", place).join(F.broadcast(offset), "part")
            .select("source", "source_size", (F.col("place") + F.col("shift")).alias("pos")))


def targets(sources: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target): shares of all sizes by weight.

    A target stops at ``max_repeats`` times the source's size; what is over is
    shared again by weight among the others until none is above. Each round is
    one small aggregate over the sources and caps at least one more of them.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    src = land(ranked(sources).withColumn("weight", weight.cast("long")), "mix-sources")
    big = T.DecimalType(38, 0)
    cap = F.col("source_size") * max_repeats
    total = src.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    free, spread = total, src.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    while spread:
        over = cap.cast(big) * F.lit(spread).cast(big) < F.col("weight").cast(big) * F.lit(free).cast(big)
        capped, light = src.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                                F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if (total - capped, light) == (free, spread):
            break
        free, spread = total - capped, light
    share = (F.col("weight") * F.lit(free)).cast("double") / F.lit(max(spread, 1)).cast("double")
    return src.select("source", "source_size", F.least(share, cap.cast("double")).alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the document's id and the seed."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|" + seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def copies(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: ``row`` (the input row as a struct), ``size``,
    ``source_size``, ``target``, ``n_copies``.

    Null texts have size 0; a null source is a source of its own, last in
    order; repeated rows are drawn alike (the draw hangs on the id and seed
    alone); an empty table gives an empty result.
    """
    row = F.struct(*[col(c) for c in docs.columns]).alias("row")
    base = docs.select(row, col("source").alias("source"), col("doc_id").alias("id"), word_count(col("text")).alias("size"))
    goal = land(targets(source_sizes(docs.select(col("source").alias("source"), word_count(col("text")).alias("size"))),
                        weights, max_repeats), "mix-targets")
    size_of = goal.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 48)).first()[0] or 0
    goal = goal.withColumnRenamed("source", "goal_source")
    joined = base.join(F.broadcast(goal) if size_of <= SOURCES_BROADCAST_BYTES else goal,
                       F.col("source").eqNullSafe(F.col("goal_source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    n = F.least(whole + F.when(draw(F.col("id"), seed) < rate - whole, 1).otherwise(0), F.lit(max_repeats))
    return joined.select("row", F.col("id").alias("doc_id"), "size", "source_size", "target", n.cast("long").alias("n_copies"))


def mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it."""
    again = fresh(docs, "again")
    taken = copies(docs, seed, weights, max_repeats).where("n_copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))).alias(again)).select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """The digest of the registered query, one row per document."""
    return copies(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("n_copies")).alias("taken"), "n_copies")
