"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014).

Nodes may be of any ordered type.  Every step is one aggregate and one join on a node; both ends of an edge go to their
smallest neighbour, so a hub with very many neighbours is only ever the target.  Each step is written to the shared
folder, so lineage stays short and a lost executor repeats one step.  Steps end when nothing changes, after a number of them that grows with the logarithm of the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import discard, materialize


def _settled(edges: DataFrame) -> bool:
    """True if every node points at one root and no root points anywhere: two aggregates, no further step."""
    roots = edges.select(F.col("v").alias("u")).distinct()
    return edges.join(roots, "u", "left_semi").isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component."""
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    while not _settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialize(large.distinct(), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        before, now = now, materialize(small.select("e.u", "e.v").where("u <> v").distinct(), name)
        discard(before, large)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
