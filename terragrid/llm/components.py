"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rounds after which the algorithm is held to be broken (it needs about the logarithm of the largest component).
MOST_ROUNDS = 64


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v), u < v: new edges (least, other)."""
    if large:  # each node sees all neighbours, and hands the larger ones to the least
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # each node sees its smaller neighbours, and hands them and itself to the least
        near = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("m").alias("u"), "v")
    else:
        out = joined.select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node reachable.

    ``edges`` has (u, v) with u < v.  Each round is written to the shared
    folder; nothing but two numbers a round reaches the driver.
    """
    now = written(edges.select("u", "v").distinct(), "edges")
    sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = sign(now)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        now = written(_star(_star(now, True), False), "edges")
        after = sign(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
