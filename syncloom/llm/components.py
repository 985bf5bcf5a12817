"""Connected components by hooking and pointer jumping, as joins and sums of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from syncloom.llm.common import Scratch


def _jump(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, parent) with every parent replaced by the root of its tree, three levels at a time."""
    while True:
        up = (
            parents.alias("n")
            .join(parents.alias("p"), F.col("n.parent") == F.col("p.node"), "left")
            .join(parents.alias("q"), F.col("p.parent") == F.col("q.node"), "left")
        )
        top = F.coalesce("q.parent", "p.parent", "n.parent")
        step = scratch.write(
            up.select("n.node", top.alias("parent"), (top < F.col("n.parent")).alias("moved")),
            "jump",
        )
        parents = step.select("node", "parent")
        if step.where("moved").isEmpty():
            return parents


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): for the nodes of the links (a, b), the smallest node they reach.

    Each round every node hooks to its smallest neighbour, trees are flattened by pointer jumping,
    and links move up to the roots; those within a tree go. A tree has two nodes at least, so the
    nodes left halve each round. Sums are taken before the shuffle, so a node of very many links
    costs no more than others.
    """
    links = scratch.write(links.where("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parents = scratch.write(
            hooks.select("node", F.least("node", "least").alias("parent")), "hooks"
        )
        roots = _jump(parents, scratch)
        if labels is None:
            labels = roots.select("node", F.col("parent").alias("component"))
        else:
            labels = scratch.write(
                labels.alias("l")
                .join(roots.alias("r"), F.col("l.component") == F.col("r.node"), "left")
                .select("l.node", F.coalesce("r.parent", "l.component").alias("component")),
                "labels",
            )
        moved = (
            links.alias("l")
            .join(roots.alias("x"), F.col("l.a") == F.col("x.node"))
            .join(roots.alias("y"), F.col("l.b") == F.col("y.node"))
            .select(F.col("x.parent").alias("a"), F.col("y.parent").alias("b"))
            .where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        links = scratch.write(moved, "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def grown(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels (node, component) after further links (a, b), of which only the roots are looked at.

    A node that has no label yet is its own root. A component's name stays its smallest node.
    """

    def rooted(column: str) -> DataFrame:
        return labels.select(F.col("node").alias(column), F.col("component").alias(f"_{column}"))

    ends = links.join(rooted("a"), "a", "left").join(rooted("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")
    )
    merged = scratch.write(components(ends, scratch), "merged")
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("_new"))
    kept = labels.join(moved, "component", "left").select(
        "node", F.coalesce("_new", "component").alias("component")
    )
    added = merged.join(labels, "node", "left_anti").select("node", "component")
    return scratch.write(kept.unionByName(added), "components")
