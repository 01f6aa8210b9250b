"""Connected components over an edge table, by alternating large-star and small-star rounds.

Each round is two grouped minima and two equi-joins; every edge stays one row.
A hub with very many neighbours is spread over the cluster: its minimum is
pre-aggregated, and its rows meet that minimum under salted keys
(``frames.looked_up``). Rounds end when the edge set stops changing; then it is
a forest of stars centred on the smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.frames import looked_up, stored


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("size"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _minima(both).select("a", F.least("a", "m").alias("m"), "size")
    # large star: neighbours above a node move to its smallest neighbour
    large = (looked_up(both, low, ["a"], "size").where(F.col("b") > F.col("a"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    # small star: a node and its neighbours below it move to the smallest of them
    low = _minima(large)
    small = looked_up(large, low, ["a"], "size").select("a", "b", "m")
    return (small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where(F.col("a") != F.col("b")).distinct())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of `edges` (a, b: long); the component is its smallest node.

    Empty edges give an empty result; loops and repeated edges change nothing;
    rows with a null end are left out. Raises if `max_rounds` don't suffice.
    """
    edges = (edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges, before = stored(edges, "edges"), None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        edges, before = stored(_round(edges), "edges"), state
    raise RuntimeError("connected components did not settle")
