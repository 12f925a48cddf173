"""Connected components of a distributed graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockpond.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first())


def _lowest(edges: DataFrame, name: str) -> DataFrame:
    """Smallest parent of each child, as a table so that a join on a hub can be split."""
    return materialize(edges.groupBy("child").agg(F.min("parent").alias("lowest")), name)


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every end of ``edges`` (``a``, ``b``, both bigint, not null).

    ``label`` is the smallest node that can be reached. Each round hangs the neighbours of a
    node under the smallest of them; rounds needed grow with the logarithm of the longest
    path. Every step is written below the shared folder, so no plan grows with the rounds and
    a lost executor costs one step. Loops (a = b) and repeated edges do no harm.
    """
    edges = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        # Large star: all larger neighbours go under the smallest neighbour (or the node itself).
        both = edges.unionByName(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
        lowest = _lowest(both, "lowest")
        large = (
            both.where("parent > child")
            .join(lowest, "child")
            .select(F.col("parent").alias("child"), F.least("child", "lowest").alias("parent"))
            .distinct()
        )
        large = materialize(large, "large-star")
        # Small star: the smaller neighbours of a node, and the node, go under the smallest of them.
        lowest = _lowest(large, "lowest")
        joined = large.join(lowest, "child")
        small = (
            joined.select("child", F.col("lowest").alias("parent"))
            .unionByName(joined.where("parent <> lowest").select(F.col("parent").alias("child"), F.col("lowest").alias("parent")))
            .distinct()
        )
        edges = materialize(small, "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("child").alias("node"), F.col("parent").alias("label"))
    return nodes.unionByName(nodes.select(F.col("label").alias("node"), "label").distinct())
