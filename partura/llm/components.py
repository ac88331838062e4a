"""Connected components of a table of links, as joins and grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.storage import Workspace


def components(ws: Workspace, links: DataFrame, tag: str) -> DataFrame:
    """(node, component) for every node of `links` (a, b): component is the smallest node reachable.

    Each round hooks every node to its neighbour of least hash, follows the hooks twice, and renames
    the ends of the links. Hash order keeps chains of hooks short whatever the ids, so the links shrink by
    a factor a round. Loops are ignored; empty links give an empty result. A node with very many links only
    adds rows to a combined minimum and to joins that adaptive execution may split.
    """
    e = ws.save(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
        f"{tag}_links0",
    )
    labels, k = None, 0
    while not e.isEmpty():
        both = e.select(F.col("a").alias("v"), F.col("b").alias("u")).union(e.select("b", "a"))
        best = both.groupBy("v").agg(F.min(F.struct(F.xxhash64("u").alias("h"), "u")).alias("m"))
        own = F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("u"))
        hook = ws.save(best.select("v", F.least("m", own)["u"].alias("p")), f"{tag}_hook{k}")
        up = hook.select(F.col("v").alias("p"), F.col("p").alias("q"))
        root = ws.save(hook.join(up, "p").select("v", F.col("q").alias("root")), f"{tag}_root{k}")
        if labels is None:
            new = root.select(F.col("v").alias("node"), F.col("root").alias("label"))
        else:
            new = labels.join(root, labels.label == root.v, "left").select(
                "node", F.coalesce("root", "label").alias("label")
            )
        old, labels = labels, ws.save(new, f"{tag}_labels{k}")
        ra, rb = (root.select(F.col("v").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        moved = e.join(ra, "a").join(rb, "b").where("ra <> rb")
        e = ws.save(
            moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            f"{tag}_links{k + 1}",
        )
        ws.drop(f"{tag}_hook{k}", f"{tag}_root{k}", f"{tag}_links{k}")
        if old is not None:
            ws.drop(f"{tag}_labels{k - 1}")
        k += 1
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return ws.save(labels.join(least, "label").select("node", "component"), f"{tag}_components")
