"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: for every id in an edge (``a, b``), the smallest id reachable.

    Each round hangs every vertex on its smallest neighbour or itself, replaces edges by
    those between the parents and drops loops and repeats, until none is left; every vertex that
    is not the smallest around it disappears, so rounds grow with the logarithm of the vertices.
    A vertex with very many edges only ever meets the single row of its own parent, on the side of a
    join that is split when it is skewed, and its minimum is combined before the shuffle.
    """
    left = stored(edges.select("a", "b").where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    label = None
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p"))
        # Chains of parents only descend; two steps at once halve them. Both sides read one shuffle.
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        parent = stored(parent.join(up, "p").select("a", F.col("pp").alias("p")), "parents")
        if label is None:
            label = parent.select(F.col("a").alias("id"), F.col("p").alias("component"))
        else:
            label = stored(label.join(parent.select(F.col("a").alias("component"), "p"), "component", "left").select(
                "id", F.coalesce("p", "component").alias("component")), "components")
        one = left.join(parent, "a").select("b", F.col("p").alias("pa"))
        two = one.join(parent.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b").where("pa <> pb")
        left = stored(two.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if label is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return label
