"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, written to the shared folder, so
no component is ever gathered in one task and a long chain shortens
logarithmically.  A node with very many links is combined before the shuffle
(minimum); the minima are written before they are joined, since adaptive
execution splits a hot key only in a join of two sides that were not grouped by
that key in the same stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipscope.llm.tables import Workspace


def _star(edges: DataFrame, large: bool, ws: Workspace, name: str) -> DataFrame:
    """Large star: link every larger neighbour of a node to the smallest of its
    neighbourhood; small star: the same for the smaller ones and the node."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(turned) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:  # hubs are neighbours of the large side only
        least = ws.save(least, f"{name}-least")
    both = around.join(least, "u")
    if large:
        out = both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(links: DataFrame, ws: Workspace, name: str, rounds: int | None = None) -> DataFrame:
    """``(node, component)`` of every node of ``links`` (columns ``u``, ``v``),
    the component being its smallest node.

    With ``rounds`` the steps stop early: nodes of one label are then still
    connected, but a component may carry several labels.
    """
    edges, seen, k = ws.save(links.where("u <> v").select("u", "v").distinct(), f"{name}-0"), None, 0
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    nodes = ws.save(nodes, f"{name}-nodes")
    while rounds is None or k < rounds:
        k += 1
        large = ws.save(_star(edges, True, ws, f"{name}-{k}"), f"{name}-{k}-large")
        edges = ws.save(_star(large, False, ws, f"{name}-{k}"), f"{name}-{k}")
        ws.drop(f"{name}-{k}-large", f"{name}-{k}-least", f"{name}-{k - 1}")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == seen:
            break
        seen = now
    label = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
