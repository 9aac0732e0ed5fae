"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import settled


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node that has an edge; ``root`` is one node of its component.

    ``edges`` has the columns a and b. Each round hooks every node to its least neighbour, follows the
    hooks to their ends and contracts the graph to these; two rounds at least halve the nodes that still
    have an edge. Edges never leave the executors. Self-loops and NULL ends are ignored, repeated edges
    count once, and no edges give no rows.
    """
    edges = settled(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = settled(
            both.groupBy(F.col("a").alias("from")).agg(F.least(F.col("from"), F.min("b")).alias("to")), "hooks"
        )
        hooks = _followed(hooks)
        moved = (
            edges.join(hooks.toDF("a", "c"), "a")
            .join(hooks.toDF("b", "d"), "b")
            .where("c <> d")
            .select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
            .distinct()
        )
        labels = settled(
            labels.join(hooks, F.col("root") == F.col("from"), "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            "labels",
        )
        edges = settled(moved, "edges")
    return labels


def _followed(hooks: DataFrame) -> DataFrame:
    """Hooks (from, to) that lead to the last node of their path; each pass doubles how far they reach."""
    while True:
        further = hooks.join(hooks.toDF("to", "end"), "to").select(
            "from", F.col("end").alias("to"), (F.col("end") != F.col("to")).alias("moved")
        )
        further = settled(further, "hooks")
        hooks = further.select("from", "to")
        if further.where("moved").isEmpty():
            return hooks
