"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``(a, b)``.

    A component is named by its least node.  Large-star and small-star rounds
    hang every node under ever smaller neighbours until nothing changes; each
    round is a few joins on narrow rows, stored, and halves long chains, so the
    rounds grow with the logarithm of the longest one.  Links with a null, and
    of a node with itself, say nothing; without links there are no nodes.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = stored(edges)
    while True:
        # Settled when every node hangs under one other that hangs under none.
        ends = edges.select(a.alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(edges.select(b.alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 or (up = 1 and down = 1)").take(1):
            break
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
        # Larger neighbours of each node hang under its least neighbour,
        large = both.join(least, a == F.col("node")).where("b > a").select(b.alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        # and so do the node itself and its smaller neighbours.
        least = large.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "node")
        small = large.join(least, a == F.col("node")).select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        edges = stored(small.where("a <> b").distinct())
    found = edges.select(a.alias("node"), b.alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
