"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; each round is written to the shared folder, which
cuts the lineage, and deleted when the next one is there. Both sides of each join are written before
they are joined: both are then plain shuffles, and adaptive execution can split the links of a large
component's root, whether its id is the smallest or the largest, which it could not if minima came
straight from their aggregate. Nothing is gathered on the driver but whether a round was the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessaria.llm.common import passing, stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links`` (bigint pairs); root is the smallest node reachable.

    Pairs that repeat or that link a node to itself change nothing; without links there is no node.
    """
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi != lo").distinct()
    with passing() as stays:
        edges = stored(edges, "edges")
        while True:
            with passing(edges) as on:
                both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
                least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.min("v").alias("first"), F.max("v").alias("last")), "least")
                # stars: every node has larger neighbours only, or one in all
                if least.filter("first < u AND first < last").isEmpty():
                    return stays(on(least)).select(F.col("u").alias("node"), F.col("m").alias("root"))
                # links may repeat in here, which minima don't mind; there are never more than edges
                large = stored(both.filter("v > u").join(least.select("u", "m"), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")), "large")
                # nodes that only have smaller neighbours keep their links to them through the neighbours' side above
                tops = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "tops")
                small = large.join(tops, "hi").filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                edges = on(stored(small.unionByName(tops.select("hi", F.col("m").alias("lo"))).distinct(), "edges"))
