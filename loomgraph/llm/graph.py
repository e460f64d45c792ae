"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import broadcast_if_small, discard, materialize


def components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node it can reach.

    Edges point from the larger node to the smaller. In each round a node and all it points at come to point at the
    smallest of them (m), and then at what that one points at (pointer jumping), so ways get shorter by a factor each
    round. The rounds end in stars. A node that many point at is never a key of the window; what the m point at is a
    table with one row for each of them, which is broadcast within a checked size and else joined as Spark sees fit
    (it splits skewed keys). A component's own smallest node points at nothing, so it isn't in that table. Null ends are
    dropped; repeated edges and loops do no harm; an empty table gives an empty one. Each round is written to the
    shared folder, and removed after the next.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null")
    loops = pairs.where("a = b").select("a", "b")
    now = materialize(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        least = now.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        star = materialize(least.select("a", "m").union(least.where("b <> m").select(F.col("b").alias("a"), "m")).distinct(), "star")
        best = star.groupBy(F.col("a").alias("m")).agg(F.min("m").alias("next"))
        hops = materialize(star.select("m").distinct().join(best, "m"), "hops")
        before, now = now, materialize(star.join(broadcast_if_small(hops), "m", "left").select("a", F.coalesce("next", "m").alias("b")).distinct(), "edges")
        discard(before, star, hops)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    stars = now.groupBy("a").agg(F.min("b").alias("component"))
    every = stars.union(now.select(F.col("b").alias("a"), F.col("b").alias("component"))).union(loops)
    return every.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("component"))
