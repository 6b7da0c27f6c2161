"""Connected components by alternating star operations.

Every round is two aggregates and joins over the edge list, written to the
shared checkpoint folder. A node's neighbours are never gathered: minima come
from partial aggregates and are joined back, so a hub with a third of all
edges is an ordinary skewed join, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge; root is its component's least node.

    ``edges`` has ``u`` and ``v`` of one orderable type. Loops, repeated
    and reversed edges are harmless; edges with a NULL end are ignored. Nodes
    that are roots themselves are left out.
    """
    e = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct().checkpoint()
    state = _state(e)
    while state[0]:
        # Large star: each node's larger neighbours move to its least one.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: each node and its smaller neighbours move to the least.
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
