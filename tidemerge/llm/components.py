"""Connected components of a link table, by alternating stars: no vertex or link reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.base import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``, where root is the smallest node it can reach.

    Each round hangs the larger neighbours of a node onto its smallest one (large star), then the smaller ones
    (small star). Rounds grow with the logarithm of the longest path. Every round is written to the shared folder. A
    node's smallest neighbour is an aggregate with a map-side part, and the join that follows can be split by AQE, so
    no task gathers a hub's links. The joins are never broadcasts: written links are far smaller than the rows they hold.
    Links that hold a null are left out; no links give an empty result.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    links = stored(pairs.distinct(), "links")
    before = None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        # the number of links and their sums stay the same only when no link moved
        now = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
        links.select("b", "b").distinct()).groupBy("node").agg(F.min("root").alias("root"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(smallest.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(smallest.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(smallest.select("a", "m")).distinct()
