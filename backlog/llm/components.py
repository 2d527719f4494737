"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node that can be reached.

    Large-star and small-star steps in turn: each takes the minimum over a node's neighbours, which tasks
    combine before the shuffle, and joins it back; a hub is split by adaptive execution. Every round is
    written to the checkpoint folder. Edges with a null end are ignored; no edges give an empty table.
    """
    both = edges.select("a", "b").where("a <> b")
    now = both.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct().checkpoint()
    for _ in range(rounds):
        large = _star(now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u"))), larger_only=True)
        small = _star(large, larger_only=False).distinct().checkpoint()
        # A forest of stars stays as it is, so equal counts and no difference end the loop.
        if small.count() == now.count() and small.exceptAll(now).isEmpty():
            now = small
            break
        now = small
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link each node's neighbours u to the least of them and the node itself.

    larger_only: `pairs` holds both directions and only neighbours above the node are linked anew;
    otherwise u < v in each pair, and the node is linked as well. The minima come to the join by a shuffle of
    their own, as a key that is worked out: adaptive execution splits a hub only if both sides come that way.
    """
    least = pairs.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").bitwiseXOR(F.lit(0)).alias("w"), F.least("m", "v").alias("m"))
    joined = pairs.join(least, F.col("v") == F.col("w"))
    if larger_only:
        return joined.where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    to_neighbours = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    to_itself = least.select(F.col("w").alias("v"), F.col("m").alias("u"))
    return to_neighbours.unionByName(to_itself)
