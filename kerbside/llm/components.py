"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settle


def _nearest(directed: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest node among ``u`` and its
    neighbours. The minimum is pre-aggregated per task, and the join back on a
    node with very many edges is one that adaptive execution can split."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return directed.join(least, directed.u == least.node).select("u", "v", "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, root), root being the smallest node
    of the component; only nodes with an edge to another node appear.

    Alternates large-star and small-star steps, which turn every component
    into a star around its smallest node in a number of rounds that grows with
    the logarithm of its size. Each round is written to the shared folder;
    only a count and a checksum come back to the driver. NULL ends and loops
    are ignored, repeated edges count once.
    """
    edges = settle(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
                   .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _nearest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        star = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = settle(star, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
