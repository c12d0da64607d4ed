"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.shared import joined, stored

MAX_NODES = 200_000  # broadcast bound for the smallest neighbours of a round
MAX_ROUNDS = 60  # large-star and small-star need about log2(nodes)**2 at worst, far fewer in practice


def _edges(edges: DataFrame, label: str) -> DataFrame:
    return stored(edges, label, state=F.bit_xor(F.xxhash64("u", "v")))


def _smallest(edges: DataFrame) -> DataFrame:
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, component being its smallest node.

    Each round writes its edges to the shared folder. In a round every node points to the smallest
    node next to it, so the stars of hot nodes shrink to one edge per member; a member that
    repeats is removed by the next distinct, which combines before its shuffle.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    e = _edges(e, "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        now = e.seen
        if now == before or now["n_rows"] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now
        # Large star: every larger neighbour of u moves to the smallest one around u.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = joined(both.filter("v > u"), _smallest(both), ["u"], "inner", MAX_NODES)
        large = near.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v")
        large = stored(large.distinct(), "large_star")
        # Small star: all smaller neighbours of u, and u, move to the smallest of them.
        near = joined(large, _smallest(large), ["u"], "inner", MAX_NODES)
        small = near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u != v")
        e = _edges(small.distinct(), "small_star")
    raise RuntimeError("components did not settle")
