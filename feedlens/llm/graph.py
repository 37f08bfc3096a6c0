"""Connected components of a large edge list by alternating large and small stars.

Every round is a few joins and aggregations; nothing about the graph reaches
the driver but a count and a checksum.  Hubs need no special care: a hub's edges
are reduced by partial aggregation and joined back under the skew rules of
adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import materialize

MAX_ROUNDS = 100


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame) -> DataFrame:
    """Joins every (a, b) to the least of a and its b's, as column m."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return edges.join(least, "a")


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``component`` (the least node reachable) for every node with an
    edge to another node; edges may repeat and run either way; null ends and
    loops are left out."""
    edges = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where(f"{left} IS NOT NULL AND {right} IS NOT NULL AND a > b")
    edges = materialize(edges.distinct())
    before = _sum(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        small = _star(large)  # repeated edges do no harm before the round's end
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        edges = materialize(small)
        now = _sum(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
