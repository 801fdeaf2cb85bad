"""Connected components of an edge table, as alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each round links every node's larger neighbours to its smallest one (large
    star) and then its smaller neighbours and itself (small star), until nothing
    changes; rounds grow with the logarithm of the longest path. Per round the
    edges are written to the shared folder. Minima are pre-aggregated and hot
    nodes meet them in joins that adaptive execution splits; nothing is
    collected. Null ends and self links are ignored, repeated edges count once.
    """
    edges = (edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u < v").distinct())
    edges = materialize(edges, "edges")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: (u, v > u) becomes (m(u), v)
        edges = (edges.join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct())
        # small star: v's smaller neighbours and v itself go to the least of them
        least = edges.groupBy("v").agg(F.min("u").alias("m"))
        edges = (edges.join(least, "v").select(F.explode(F.array(
            F.struct(F.col("m").alias("u"), F.col("v").alias("v")), F.struct(F.col("m").alias("u"), F.col("u").alias("v"))))
            .alias("e")).select("e.u", "e.v").where("u < v").distinct())
        edges = materialize(edges, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
            .unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()))
