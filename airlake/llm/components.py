"""Connected components of a graph given as an edge table, by contraction in joins and aggregations."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import stored


def connected_components(edges: DataFrame, seed: int = 1) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst as long); the component is its smallest node.

    Each round every node moves to the least of itself and its neighbours in an order that changes with the round
    (node XOR a fixed random mask), and edges follow; long chains therefore shrink by a constant share a round, and
    the edge table with them. Rounds are stored in the shared folder, so a lost executor repeats one round at most.
    A node with a third of all edges is aggregated on the map side first and is split by the skew join after.
    Null ends, self-links and repeated edges are ignored; an empty table has no components.
    """
    masks = random.Random(seed)
    edges = edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
    edges = stored(edges.where("u <> v").distinct(), "edges-0")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        mask = F.lit(masks.getrandbits(63))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = (
            both.groupBy(F.col("u").alias("node"))
            .agg(F.min(F.col("v").bitwiseXOR(mask)).alias("least"))
            .select("node", F.least("least", F.col("node").bitwiseXOR(mask)).bitwiseXOR(mask).alias("to"))
        )
        moved = stored(moved, f"moves-{len(moves)}")
        moves.append(moved)
        left = moved.select(F.col("node").alias("u"), F.col("to").alias("a"))
        right = moved.select(F.col("node").alias("v"), F.col("to").alias("b"))
        edges = edges.join(left, "u").join(right, "v")
        edges = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct()
        edges = stored(edges, f"edges-{len(moves)}")
    if not moves:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    root = moves[-1]
    for earlier in reversed(moves[:-1]):
        later = root.select(F.col("node").alias("to"), F.col("to").alias("root"))
        root = earlier.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    root = stored(root, "roots")
    least = root.groupBy("to").agg(F.min("node").alias("component"))
    return root.join(least, "to").select("node", "component")
