"""Connected components as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import released, settled


def components(edges: DataFrame) -> DataFrame:
    """``(v, c)`` for every vertex of ``edges (a, b)``: ``c`` is the smallest vertex it is connected to.

    Every vertex hooks onto its smallest neighbour if that is smaller, hooks are followed once,
    and edges are drawn anew between the hooks until none is left. A vertex never meets its
    neighbours in one row: only their minimum is taken, which tasks combine before the shuffle.
    Each round's tables are written to the shared folder, and deleted when the next round stands. Null ends must not occur.
    """
    edges = settled(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        near = settled(least.select(F.col("a").alias("v"), F.least("a", "b").alias("p")), "hooks")
        far = near.select(F.col("v").alias("p"), F.col("p").alias("q"))
        hook = settled(near.join(far, "p").select("v", F.col("q").alias("p")), "hooks")
        if labels is None:
            joined = hook.select("v", F.col("p").alias("c"))
        else:
            new = hook.select(F.col("v").alias("c"), "p")
            joined = labels.join(new, "c", "left").select("v", F.coalesce("p", "c").alias("c"))
        old, labels = labels, settled(joined, "labels")
        a, b = hook.select(F.col("v").alias("a"), F.col("p").alias("pa")), hook.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        drawn = edges.join(a, "a").join(b, "b").where("pa <> pb")
        drawn = settled(drawn.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        released(old, near, hook, edges)
        edges = drawn
    released(edges)
    return labels
