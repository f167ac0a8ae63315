"""Connected components of links, by joins and sums that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of every node in `links` (a, b).

    Alternates large-star and small-star steps: each step hangs neighbours on their
    smallest one and keeps the number of links in proportion. Every round is written to
    the shared folder. Ends when a round changes nothing.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small, "links")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")
        ).first()
        # One link per node, and the same links as before: stars.
        if now == before and now[0] == now[2]:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
