"""Connected components of an undirected graph by alternating large and small stars."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import materialize


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for every end of edges(a, b); the component is its smallest node.

    Each round is two grouped minima and joins, without collecting a node's neighbours, and cuts its lineage by a
    written table.  It ends when a round changes nothing; where a number of rounds is given and they run out before that,
    it raises an error.
    """
    edges = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = None
    for done in count():
        if done == rounds:
            raise RuntimeError(f"components are unfinished after {rounds} rounds")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = materialize(small, "cc")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
