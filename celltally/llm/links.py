"""Connected components of links between ids, by star contraction.

Each round points every id at the smallest neighbour of its neighbours (large
star, then small star) and writes the links to the shared folder; minima are
aggregated before the shuffle and joined back, so an id with very many links
is never gathered. The driver sees a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm.common import land


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every linked id that is not itself the smallest of its
    component. ``links``: columns a, b. Null ids and self links are ignored."""
    edges = land(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = land(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
