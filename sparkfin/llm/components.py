"""Connected components of an edge table by alternating large and small stars.

Large star: every node hands its larger neighbours to its smallest neighbour.
Small star: every node hands itself and its smaller neighbours to the smallest
of them.  Both keep the components and flatten them until every node hangs
directly on the smallest node of its component.  Each round is a grouped
minimum (combined before the shuffle) and a join, so a node with very many
neighbours is never gathered; rounds are cut by written tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest
    node of its component.  Self edges and repeated edges may occur."""
    e = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = None
    while True:
        # small star over edges (u > v): u and its other lower ends hang on the lowest
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e2 = e.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        # large star: all higher ends of a node hang on its lowest end or itself
        both = e2.unionByName(e2.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        last = e
        e = written(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .filter("u <> v").distinct(), name)
        release(last)
        state = e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
