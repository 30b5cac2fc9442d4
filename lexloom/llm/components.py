"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm import shared as S

#: Links that one task takes.
PART_ROWS = 50_000


def _stars(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """Every node hands its neighbours (the larger ones, or itself and the smaller ones) to the least of them."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # partial minima meet the edges again in a join, whose hot nodes the engine splits: a window would take a node's edges in one task
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    seen = around.join(least, "u").withColumn("m", F.least("m", "u"))
    if large:
        made = seen.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = seen.select("u", F.col("m").alias("v"))
        made = own.unionByName(seen.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
    # neither kind of star makes more edges than there were nodes and edges
    return made.filter(F.col("u") != F.col("v")).coalesce(parts).distinct().coalesce(parts)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v): root is the least node it can reach.

    Each round halves the height of the trees, so rounds grow as the logarithm of the
    longest path. Links and labels stay distributed; each round is checkpointed.
    """
    edges = S.durable(links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), PART_ROWS)
    parts = S.parts_for(edges.count(), PART_ROWS)
    before = None
    while True:
        last, edges = edges, S.durable(_stars(_stars(edges, True, parts), False, parts))
        S.release(last)
        # sums of hashes of all edges: alike only where the edges are
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
