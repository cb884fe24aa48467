"""Connected components of an edge table, by alternating star contractions.

Each round joins every node's rows with the node's smallest neighbour: first towards larger,
then towards smaller nodes, until nothing changes (about log2 of the longest path rounds).
Smallest neighbours are aggregated before they are shuffled, and each join has at most one
row per node on the right, so that a node with many edges can be split over tasks. Rounds
are cut by tables in the checkpoint folder; the driver sees one count and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours and itself to its smallest neighbour."""
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = sides.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), "m")
    else:
        out = joined.select(F.col("b").alias("a"), "m").unionByName(least)
    return out.where("a <> m").select("a", F.col("m").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with an edge.

    Edges with a null end or two equal ends link nothing; nodes that have no other edge
    have no row. Repeated edges count once. An empty table gives an empty one.
    """
    stars = cut(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = None
    while True:
        seen = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == state:
            break
        state = seen
        stars = cut(_star(_star(stars, large=True), large=False))
    roots = stars.select("b").distinct().select(F.col("b").alias("a"), "b")
    return stars.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
