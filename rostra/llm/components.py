"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rostra.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: ``root`` is the smallest node that can be reached.

    Rounds of two steps: each node ties its larger neighbours to its smallest neighbour, then its smaller neighbours. Edges
    only shrink in number, and the depth falls by half or more a round. Nothing but a count goes to the driver; each
    round is written to the shared folder, so a lost executor costs one round.
    """
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        far = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = far.groupBy("u").agg(F.min("v").alias("m"))
        tied = far.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(tied.unionByName(near.select("u", F.col("m").alias("v"))).where("u <> v")
                            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
