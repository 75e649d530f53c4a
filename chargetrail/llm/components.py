"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargetrail.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, its smallest reachable node, for every node of the edges (`a`, `b`) but the smallest.

    Alternates two steps until every node hangs on one root: hang larger neighbours on the smallest neighbour, then hang
    all smaller neighbours on the smallest. Minima are combined before each shuffle and written before they are joined
    back, so that a node with very many neighbours can be split; the number of rounds grows with the logarithm of the
    longest path. Nothing but a count comes to the driver.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    current = edges.where("a != b").select(larger, smaller)
    while not _finished(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = materialise(hung.distinct(), "hung")
        least = materialise(hung.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = hung.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = materialise(moved.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()


def _finished(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none if it is one: then all hang on roots."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("least"), F.col("v").alias("most"), F.lit(0).alias("below"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("node"), F.lit(1).alias("below")), allowMissingColumns=True
    )
    nodes = ends.groupBy("node").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.max("below").alias("below"))
    return nodes.where("least != most OR (least IS NOT NULL AND below = 1)").agg(F.count("*")).first()[0] == 0
