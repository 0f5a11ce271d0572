"""Connected components of a link table by alternating stars.

Large-star and small-star steps turn every component into a star around its smallest node. Each step is one
aggregation and one join; no node's neighbours are ever gathered in one place, so a group of copies that holds
a third of the rows is dealt out like any other (the join can be split where it is skewed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _with_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) rows with the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("__m")).select(F.col("u").alias("__u"), F.least("__m", "u").alias("m"))
    return pairs.join(least, F.col("u") == F.col("__u")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    return _with_smallest(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    starred = _with_smallest(down)
    return starred.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(starred.select("u", "m"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Columns node, component for every node with a link; component is the smallest node reachable.

    ``edges`` has long columns a and b; self links, repeated links and an empty table are fine.
    """
    now = stage(edges.filter("a <> b").select("a", "b").distinct(), "links")
    seen = None
    for _ in range(rounds):
        now = stage(_small_star(_large_star(now)).distinct(), "stars")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    hubs = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(hubs)
