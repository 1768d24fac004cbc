"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import staged


def _star(neighbours: DataFrame) -> DataFrame:
    """Point every neighbour of u, and u itself, to the least node among them, where that changes anything."""
    least = neighbours.groupBy(F.col("u").alias("hub")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return neighbours.join(least, F.col("u") == F.col("hub"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
    linked = _star(both).where("v > u AND v <> m")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _star(down)
    own = linked.select("u", F.col("m").alias("v"))
    return linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()


def least_nodes(edges: DataFrame) -> DataFrame:
    """For ``edges`` (u, v) one row (node, root) per node with an edge but for the roots, the least nodes of components.

    Every round reads the edges of the round before from the shared folder and halves distances, so the number of
    rounds grows with the logarithm of the longest chain. Edges between a node and itself are left out.
    """
    current, state = staged(edges.where("u <> v").distinct(), "components"), None
    while True:
        current = staged(_small(_large(current)), "components")
        found = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(found)
