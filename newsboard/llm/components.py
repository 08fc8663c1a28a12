"""Connected components of a graph of 64-bit nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsboard.llm.common import hot_join, landed


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with the least neighbour of u or u itself as m."""
    edges = landed(edges, "edges")
    least = landed(
        edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree")), "least"
    )
    return hot_join(edges, least, "u", "degree")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_least(both)
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    known = _with_least(edges)
    up = known.select("u", F.col("m").alias("v"))
    across = known.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return up.unionByName(across).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the least node
    that can be reached from it.

    Large and small stars alternate until the edges no longer change; the
    rounds grow with the logarithm of the longest path.  Every round is a
    stored table.  The node that many others point to is a hot key and joined
    as such; least neighbours are map-side minima.  Loops and repeated edges
    change nothing; no edges give no rows.
    """
    pairs = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = landed(pairs.distinct(), "stars")
    mark = _mark(now)
    while mark[0]:
        now = landed(_small_star(landed(_large_star(now), "stars")), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
