"""Connected components of a link table, in written rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import discard, materialize


def _ranked(column: str) -> Column:
    """A node with a rank by hash, so that no order of ids makes long chains."""
    return F.struct(F.xxhash64(column).alias("rank"), F.col(column).alias("node"))


def _tidy(edges: DataFrame) -> DataFrame:
    a, b = F.least("u", "v"), F.greatest("u", "v")
    return edges.select(a.alias("u"), b.alias("v")).filter("u < v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(id, component): the smallest node that links lead to, for every linked
    node. Nodes are of any type that has an order.

    Each round hooks every node to its smallest neighbour by rank, follows the
    pointers twice, and contracts the edges. A third of the nodes of a chain
    are smaller than both neighbours, and stars end in one round, so rounds
    grow with the logarithm of the longest path. Each round replaces the tables
    of the one before. The smallest node is looked up at the end.
    """
    named = edges.select(F.col(u).alias("_u"), F.col(v).alias("_v")).filter("_u is not null and _v is not null")
    live = materialize(_tidy(named.select(_ranked("_u").alias("u"), _ranked("_v").alias("v"))), "edges")
    labels = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        parent = materialize(parent, "parents")
        for _ in range(2):
            upper = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = materialize(parent.join(upper, "p").select("u", F.col("pp").alias("p")), "parents")
            discard(parent)
            parent = jumped
        if labels is None:
            new = materialize(parent.select(F.col("u").alias("id"), F.col("p").alias("root")), "labels")
        else:
            moved = labels.join(parent.withColumnRenamed("u", "root"), "root", "left")
            new = materialize(moved.select("id", F.coalesce("p", "root").alias("root")), "labels")
            discard(labels)
        a = parent.select("u", F.col("p").alias("a"))
        b = parent.select(F.col("u").alias("v"), F.col("p").alias("b"))
        left = _tidy(live.join(a, "u").join(b, "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
        left = materialize(left, "edges")
        discard(live, parent)
        live, labels = left, new
    if labels is None:
        return live.select(F.col("u.node").alias("id"), F.col("v.node").alias("component"))
    smallest = labels.groupBy("root").agg(F.min("id.node").alias("component"))
    return labels.join(smallest, "root").select(F.col("id.node").alias("id"), "component")
