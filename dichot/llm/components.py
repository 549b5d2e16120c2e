"""Connected components of a link table by alternating star contraction.

Every step is a grouped minimum (combined map-side) and an equi-join, so a
star with a third of all nodes costs no more per task than any other graph;
the table never reaches the driver, only its row count and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import checked_broadcast, freed, written

#: nodes of a small graph, whose minima are broadcast instead of shuffling the links again
SMALL = 1 << 16


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of ``links``: ``root`` is the smallest node
    reachable.  Self-links keep a node; nulls link nothing; no links, no rows."""
    edges = (links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    edges = written(edges, "links")
    n = edges.count()
    mark = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(checked_broadcast(low, 2 * n, SMALL), "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        loops = edges.where("hi = lo")
        step = large.where("hi <> lo").union(loops).distinct()
        least = step.groupBy("hi").agg(F.min("lo").alias("m"))
        small = step.join(checked_broadcast(least, 2 * n, SMALL), "hi")
        before = edges
        edges = written(small.select("hi", F.col("m").alias("lo"))
                        .union(small.select(F.col("lo"), F.col("m"))).distinct(), "links")
        freed(before)
        # a forest of stars: every node points at its root, and no root at another
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        n = seen[0]
    return edges.groupBy("hi").agg(F.min("lo").alias("root")).withColumnRenamed("hi", "node")
