"""Connected components by contraction to least neighbours with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, release


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (a bigint, b bigint).

    Each round every node points at its least neighbour or itself; the trees
    of these pointers are flattened by pointer jumping (their depth halves
    with every join) and edges are contracted to the roots at their ends,
    inner ones dropped. Every root that still has an edge joins another tree
    in the next round, so the number of roots at least halves and a long chain
    collapses at once. What a round makes is written to a table, and joins are
    sort-merge joins, so nothing of the graph passes through the driver.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    pairs = checkpointed(pairs)
    labels = None
    while not pairs.isEmpty():
        # least neighbours are combined map-side, so a hub's edges do not meet in one task
        both = pairs.select(F.col("b").alias("x"), F.col("a").alias("y")).unionByName(
            pairs.select(F.col("a").alias("x"), F.col("a").alias("y")))
        parent = checkpointed(both.groupBy("x").agg(F.min("y").alias("p")))
        while True:
            up = parent.select(F.col("x").alias("p"), F.col("p").alias("g"))
            jumped = checkpointed(parent.join(up.hint("merge"), "p").select("x", F.col("g").alias("p"), (F.col("g") != F.col("p")).alias("moved")))
            parent = jumped.select("x", "p")
            if jumped.where("moved").isEmpty():
                break
        one, two = (parent.select(F.col("x").alias(c), F.col("p").alias("p" + c)) for c in "ab")
        pairs = checkpointed(pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b")
                             .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                             .where("a < b").distinct())
        if labels is None:
            labels = parent.select(F.col("x").alias("node"), F.col("p").alias("component"))
        else:
            step = parent.select(F.col("x").alias("component"), F.col("p").alias("next"))
            labels = (labels.join(step.hint("merge"), "component", "left")
                      .select("node", F.coalesce("next", "component").alias("component")))
        labels = checkpointed(labels)
        release(edges.sparkSession)
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
