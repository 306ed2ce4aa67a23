"""Connected components of a set of edges, by alternating star contractions.

Each round hangs every node's larger neighbours on its least neighbour, then its
lesser ones. Rounds end when nothing changes; their number grows with the logarithm
of the longest chain. Minima combine on the map side and are stored before the joins
that follow, so that adaptive execution can split the partition of a hot node. Every
round is stored, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """From edges (a, b): node and the least node of its component, for nodes that have an edge."""
    now = stage.table(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    seen = _checksum(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stage.table(least, "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage.table(large.distinct(), "stars")
        below = stage.table(large.groupBy("u").agg(F.min("v").alias("m")), "below")
        small = large.join(below, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage.table(small.unionByName(below.select("u", F.col("m").alias("v"))).distinct(), "edges")
        last, seen = seen, _checksum(now)
        if seen == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
