"""Connected components over an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join; nothing is collected.  A node
with a very high degree costs one aggregated row per map task, and its join side
is split by AQE's skew join.  Each round's edges are cut off with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.session import checkpoint_root


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` with a != b, undirected -> ``(node, root)``: the smallest node reachable from each node.

    Nodes without an edge are not listed; their root is themselves.  Nodes are
    ordered as signed integers.  The number of rounds grows with the logarithm of
    the longest path.
    """
    checkpoint_root(edges.sparkSession)
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    before = None
    while True:
        # large star: every neighbour above u is linked to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u <> v").distinct())
        # small star: u and its neighbours below are linked to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = (e.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
             .select("e.u", "e.v").where("u <> v").distinct().checkpoint())
        # the edge set is a star forest once a round changes neither its size nor its checksum
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
