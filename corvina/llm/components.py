"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _with_min(edges: DataFrame) -> DataFrame:
    """u, v, and m: the least of u and its neighbours in this table.

    Minima are taken before the shuffle, and written: Spark can split a hot key of the join only if
    neither side is the aggregate itself.
    """
    least = written(edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")))
    return edges.join(least, F.col("u") == F.col("k")).select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (its least reachable node) for every node in edges.

    Each round, first every node hands its larger neighbours to the least node that it sees, then
    its smaller ones; edges never outnumber those of the start, and trees become stars in a number
    of rounds that is logarithmic in the longest path. Loops and repeated edges do no harm; null
    ends are left out.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    now = written(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = _with_min(large)
        step = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = written(step.where("u > v").distinct())
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
