"""Connected components of a graph too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash


def connected_components(edges: DataFrame, stash: Stash) -> DataFrame:
    """``node, component`` for the nodes of ``edges(a, b)``; a component is named by one of its nodes.

    Each round points every node at the least of itself and its neighbours and replaces edges by edges between the
    nodes pointed at. Nodes must be hashes or otherwise in random order: then a round takes away a constant share of
    the nodes, so that the rounds grow with the logarithm of the largest component. A star is done in one round.
    A node with very many edges is aggregated before the shuffle; both sides of the joins are written tables, whose
    large partitions adaptive execution splits.
    """
    edges = stash.keep(edges.where("a <> b").select("a", "b").distinct(), "edges")
    pointers = []
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        to = stash.keep(least.select("node", F.least("node", "b").alias("to")), "pointers")
        pointers.append(to)
        ends = [to.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in "ab"]
        moved = edges.join(ends[0], "a").join(ends[1], "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        edges = stash.keep(moved.where("a <> b").distinct(), "edges")
        if edges.isEmpty():
            break
    found = pointers[0].withColumnRenamed("to", "component")
    for to in pointers[1:]:
        on = to.withColumnRenamed("node", "component")
        found = (
            found.join(on, "component", "left")
            .select("node", F.coalesce("to", "component").alias("component"))
        )
    return stash.keep(found, "components")
