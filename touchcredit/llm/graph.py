"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the smallest node it can reach.

    Each round is two groupings by node, of which only a minimum is kept, and joins back; a node with very
    many links is no hot group. Nothing but the count of changed links comes to the driver.
    """
    links = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                .where("hi <> lo").distinct())
    while True:
        both = links.union(links.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = cut(large.where("hi <> lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", F.col("m").alias("lo"))).where("hi <> lo").distinct())
        small = cut(small)
        # the same number of links and no new one: nothing moves any more
        same = small.join(links, ["hi", "lo"], "left_anti").limit(1).count() == 0 and small.count() == links.count()
        links = small
        if same:
            break
    roots = links.select(F.col("lo").alias("node")).distinct()
    return (links.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
            .union(roots.select("node", F.col("node").alias("label"))))
