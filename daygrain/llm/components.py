"""Connected components of a graph of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import forget, written


def _rooted(parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``v, p`` with p the root of v's tree, and the copy it is read from.

    Every row jumps to its parent's parent until none moves.
    """
    before = parents
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("up"))
        jumped = written(
            parents.join(up, "p", "left").select(
                "v", F.coalesce("up", "p").alias("p"), (F.coalesce("up", "p") != F.col("p")).alias("moved")
            ),
            "parents",
        )
        forget(before)
        parents, before = jumped.select("v", "p"), jumped
        if jumped.filter("moved").isEmpty():
            return parents, before


def components(links: DataFrame) -> DataFrame:
    """``node, component_id`` for every node of ``links`` (columns a, b): the smallest node reachable.

    Each round gives every node the smallest of its neighbours and itself as parent, follows parents
    to the root, and keeps the links between different roots. At least half of the linked nodes
    merge in a round, so rounds grow with the logarithm of the graph. Each step is a join of narrow
    tables written to the shared folder; nothing is collected. A node of very many links is combined
    before the shuffle, or its partition split by the join.

    Links with a null end or of a node with itself are ignored; no links give no rows.
    """
    links = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(
            both.groupBy(F.col("a").alias("v")).agg(F.min(F.least("a", "b")).alias("p")), "parents"
        )
        roots, copy = _rooted(parents)
        old = labels
        if labels is None:
            labels = roots.select(F.col("v").alias("node"), F.col("p").alias("component_id"))
        else:
            moved = roots.select(F.col("v").alias("component_id"), "p")
            labels = labels.join(moved, "component_id", "left").select(
                "node", F.coalesce("p", "component_id").alias("component_id")
            )
        labels = written(labels, "labels")
        ends = links
        for end in ("a", "b"):
            root = roots.select(F.col("v").alias(end), F.col("p").alias("root"))
            ends = ends.join(root, end).drop(end).withColumnRenamed("root", end)
        left = links
        links = written(ends.filter("a <> b").distinct(), "links")
        forget(left, copy, old)
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    return labels
