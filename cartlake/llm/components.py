"""Connected components of a graph given by its links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.session import stage


def large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """For every node (a) that has a link: the least node (b) that it is connected with;
    least nodes themselves have no row.

    Links (a, b) have no nulls and may repeat or point to their own node. A round reads
    what the last one wrote to the shared folder, so lineage stays short. A node with many
    links is never gathered: its least neighbour is a partial aggregate, and the join that
    follows may be split.
    """
    links = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    for _ in range(rounds):
        links = stage(small_star(large_star(links)), "stars")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links
        state = now
    raise RuntimeError("components did not settle; allow more rounds")
