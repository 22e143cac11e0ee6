"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct edges (a > b), written, with a signature of their set."""
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct())
    r = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return e, (r[0], r[1])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not itself the smallest of its part.

    ``edges`` has bigint columns a, b in any order.  Each round points larger
    neighbours (large star) and then smaller ones (small star) at the smallest;
    rounds grow with the logarithm of the node count.  Per-node minima are
    combined map-side and written before the join back, so a hub's edges can be
    split over tasks.  Nothing is collected but an edge count and hash a round.
    """
    e, seen = _stored(edges)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e2, _ = _stored(large)
        low = cut_lineage(e2.groupBy("a").agg(F.min("b").alias("m")))
        small = (e2.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        e, now = _stored(small)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
