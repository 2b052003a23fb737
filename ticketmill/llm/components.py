"""Connected components of a table of links, by stars that grow and shrink.

Two steps repeat until each node hangs on the smallest node it can reach. The large step links every
neighbour above a node to the smallest one around it, the small step every one below. Both take
minima by aggregation and joins, so a node with very many links is never one group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.tables import discard, stored


def _star(links: DataFrame) -> DataFrame:
    """Links (a, b) with a > b: each a with all of its b; the new links of the small step."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    joined = links.join(least, "a")
    down = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
    return down.unionByName(least.select("a", F.col("low").alias("b"))).where("a > b").distinct()


def _spread(links: DataFrame) -> DataFrame:
    """The new links of the large step."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), root being the smallest node it reaches.

    Links run either way, may repeat and may join a node to itself; rows with a null are left out.
    Each round is a written table, so a lost executor costs one round.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL")
    loops = ends.where("a = b").select(F.col("a").alias("node")).distinct()
    now = stored(
        ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    seen = now.agg(F.count("*").alias("n"), digest.alias("digest")).first()
    while seen.n:
        after = stored(_star(_spread(now)), "links")
        fresh = after.agg(F.count("*").alias("n"), digest.alias("digest")).first()
        discard(now)
        now, before, seen = after, seen, fresh
        if before == fresh:
            break
    rooted = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rooted.select(F.col("root").alias("node"), "root").distinct()
    alone = loops.join(rooted.select("node").union(roots.select("node")), "node", "left_anti")
    return rooted.unionByName(roots).unionByName(alone.select("node", F.col("node").alias("root")))
