"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two joins of the edges with the least neighbour of a node. That least neighbour is an aggregate with
map-side partial results (one row per node) and is written before the join; the edges of a node that holds a share of all
edges are dealt over tasks (``common.join_back``), so a hub is never gathered in one. Rounds grow with the logarithm of
the component size. Every step is a written table: it cuts the lineage, and its size is known (Spark multiplies the sizes
of joined inputs, and over rounds of checkpoints, which keep such guesses, the numbers would grow without end). Only
counts and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_back, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v. Link every neighbour (larger ones, or the node and its smaller ones) to the least."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("_n")), "least")
        # the larger neighbours of a node: the edges turned round
        out = join_back(edges.select(F.col("v").alias("u"), F.col("u").alias("v")), least, "u", "_n").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n")), "least")
        out = (join_back(edges.select("u", "v"), least, "u", "_n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` that is not the least of its component.

    Null ends and self-loops are ignored; repeated edges change nothing; an empty table gives an empty one. Raises
    if ``max_rounds`` rounds don't suffice (never silently partial).
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = written(_star(written(_star(now, large=True), "edges"), large=False), "edges")
        state = _state(now)
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError(f"components not found in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.shiftright(F.xxhash64("v", "u"), 20))).first())
