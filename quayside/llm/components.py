"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star rounds: each round hangs every neighbour
of a node on the smallest node it sees, first for larger neighbours, then for
smaller ones, until the edges form stars around the smallest node of each
component. Rounds grow with the logarithm of the graph. The minimum of a node is
aggregated map-side and joined back, so a hub's edges are never gathered in one
group, and each round is written to the shared folder, so it survives lost
executors. Only a row count and a checksum per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")) \
        .select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """Rows (node, component) for every node of ``edges``; component is its smallest node.

    Edges have no direction; loops and edges with a null end are ignored, repeated
    ones count once. Nodes may be of any type that has an order. No edges give no rows.
    """
    nodes = edges.select(F.col(left).alias("u"), F.col(right).alias("v")) \
        .where("u is not null and v is not null")
    current = cut_lineage(
        nodes.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct())
    seen = None
    while True:
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == seen or row[0] == 0:
            break
        seen = tuple(row)
        current = cut_lineage(_small_star(_large_star(current)).distinct())
    hung = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = nodes.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    return hung.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
