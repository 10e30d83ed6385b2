"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import cut, release


def _stars(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each row of ``pairs`` with the smallest neighbour of u, u itself included."""
    low = pairs.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("low"))
    return pairs.join(low, pairs["u"] == low["w"]).select("u", "v", F.least("u", "low").alias("m"))


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of an edge with the smallest node that it reaches.

    Neighbour lists are never gathered: a step is a partial minimum and a join
    on the node, whose large keys Spark can split. Each step's edges are
    checkpointed. Rounds grow with the logarithm of the longest path; stars
    are done in one.
    """
    plain = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")
    now = cut(plain.distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        star = _stars(large)
        small = star.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(star.select("u", F.col("m").alias("v")))
        now = cut(small.where("u != v").distinct())
        release(now.sparkSession)
        new = _mark(now)
        if new == mark:
            break
        mark = new
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)
