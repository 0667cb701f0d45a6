"""Connected components of a table of links, by alternating stars.

Each round every node hands its larger neighbours, then its smaller ones, to the smallest node it knows. Rounds grow
with the logarithm of the longest path; each is a grouped minimum (combined before the shuffle) and a join, which
adaptive execution can split where one node has very many links. Nothing is collected but a count and a sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v. Gives the rewritten edges, again with u > v."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if large:  # the smallest of u and all its neighbours; larger neighbours are handed on
        least = least.select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where("u > v").distinct()
    out = both.join(least, "u")
    handed = out.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(s: Scratch, links: DataFrame) -> DataFrame:
    """links (a, b), in any order and with repeats → (node, component): the smallest node that each can reach.

    Nodes without a link to another node do not appear. An empty table gives an empty one.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = s.table(edges)
    seen = None
    while True:
        new = s.table(_star(_star(edges, True), False))
        n, total = new.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
        ).first()
        s.drop(edges)
        edges = new
        if (n, total) == seen:
            break
        seen = (n, total)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
