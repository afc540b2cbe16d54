"""Connected components of a graph given by its links, in rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b: long), where root is the smallest node of its component.

    Alternating large and small stars: each node learns the smallest node among its neighbours, and its larger (then its
    smaller) neighbours are linked to that one. Rounds grow with the logarithm of a component's size. Each round is
    written to the shared folder. A node with very many links is reached by partial minima and by a join on a plain key, whose
    hot partition AQE can split.
    """
    links = links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct()
    links = written(links, "links")
    while True:
        large = _star(links, both_ways=True)
        small = written(_star(large, both_ways=False), "links")
        if _same(links, small):
            break
        links = small
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links (lo, hi). Large star: neighbours above a node join its smallest neighbour. Small star: those below do."""
    down = links.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
    pairs = down.union(links.select(F.col("lo").alias("node"), F.col("hi").alias("other"))) if both_ways else down
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    if both_ways:
        made = links.select(F.col("lo").alias("node"), F.col("hi").alias("other")).join(least, "node")
        made = made.select(F.col("least").alias("lo"), F.col("other").alias("hi"))
    else:
        made = down.join(least, "node").select(F.col("least").alias("lo"), F.col("other").alias("hi"))
        made = made.union(least.select(F.col("least").alias("lo"), F.col("node").alias("hi")))
    return made.where("lo < hi").distinct()


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two sets of links are equal, by count and sums that hardly collide."""
    digest = [F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("hi", "lo"))]
    return a.agg(*digest).first() == b.agg(*digest).first()
