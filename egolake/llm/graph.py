"""Connected components by alternating large-star and small-star contraction.

Every step takes a minimum per node, which Spark pre-aggregates before the shuffle, so a
node with very many links never gathers them in one task. Edges are materialised after
each round; the driver sees one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node of its component.

    Loops, repeated and null edges are ignored. No edges give no rows. Nodes may be of any
    ordered type.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = materialize(e.where(F.col("u") != F.col("v")).distinct(), "edges")
    while not e.select("v").distinct().join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
