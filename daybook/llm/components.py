"""Connected components by joins: every node points at the smallest node known, until nothing changes.

Each round links, around every node, the larger neighbours to its smallest neighbour, then the node and
its smaller neighbours to the smallest. The links of a node are never gathered: the smallest neighbour
comes from a pre-aggregated minimum and is joined back. Each round is a written table, so a lost executor
costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import settle


def large_star(links: DataFrame) -> DataFrame:
    both = links.select("src", "dst").union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least")).select("src", F.least("src", "least").alias("least"))
    up = both.where("dst > src").join(least, "src").select(F.col("least").alias("src"), "dst")
    return up.where("src < dst").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Here every link has src < dst: dst's smaller neighbours, and dst itself, go to the smallest of them."""
    least = links.groupBy("dst").agg(F.min("src").alias("least"))
    side = links.join(least, "dst").select(F.col("least").alias("src"), F.col("src").alias("dst")).where("src < dst")
    return side.union(least.select(F.col("least").alias("src"), "dst")).distinct()


def state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root (its component's smallest node) for every node of the links (src < dst, distinct) but the roots."""
    before = state(links)
    while before[0]:
        links = settle(small_star(large_star(links)), "components")
        now = state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("dst").alias("node"), F.col("src").alias("root"))
