"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linespan.llm.common import discard, settle

ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour to the least node of the neighbourhood."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Return node and component (its least node) for every node with a link.

    ``links``: u, v, longs. A hub's links are counted before the shuffle, and
    each round writes its links, so a lost executor costs one round.
    """
    now = settle(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            labels = settle(
                now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                    now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
                ),
                "labels",
            )
            discard(now)
            return labels
        before, last = mark, now
        now = settle(_small_star(_large_star(last)), "links")
        discard(last)
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
