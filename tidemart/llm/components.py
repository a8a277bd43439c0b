"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the component's least node.

    Large-star and small-star rounds: every node's larger neighbours, then its smaller ones,
    are hung on its least neighbour, until each node has one edge, to its root. The number
    of rounds grows with the logarithm of the longest path. Each round is written to the
    shared folder, which cuts the lineage. Nothing is collected but one count per round.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        name,
    )
    while True:
        large = _star(current, larger=True)
        following = stored(_star(large, larger=False), name)
        # Done when all are stars: each node hangs on one other, which hangs on none.
        hangs = following.groupBy("u").agg(F.count("*").alias("n"))
        bad = hangs.where("n > 1").select("u").union(
            hangs.select("u").join(following.select(F.col("v").alias("u")), "u", "left_semi")
        )
        current = following
        if not bad.limit(1).count():
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v"), F.col("v")).distinct()
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (u > v) with each node's larger (or smaller) neighbours hung on its least one."""
    both = edges.union(edges.select("v", "u")) if larger else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.least("m", "u").alias("m")
    )
    joined = both.join(least, both["u"] == least["n"])
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select(F.col("u"), F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()
