"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wearline.session import settle


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    inner = down.join(low, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return inner.union(low.select("u", "m")).distinct()


def _mark(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of its component.

    Each round halves the longest way to a root or better and is written to the shared folder; two
    numbers per round reach the driver.
    """
    current, seen = links.where("a != b"), None
    for _ in range(rounds):
        current = settle(_small_star(_large_star(current)), "links")
        mark = _mark(current)
        if mark == seen or mark[0] == 0:
            return current.toDF("node", "root")
        seen = mark
    raise RuntimeError(f"links still change after {rounds} rounds")
