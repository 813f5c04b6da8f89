"""Connected components of a table of links, by alternating large and small stars.

Each round is two groupings and two joins on the links; the links are written
to the shared folder after each round, so no lineage grows, nothing is lost
with an executor, and no component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the smallest of the node and its neighbours."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of these. Links run from the larger to the smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node of links (a, b) that isn't its own root."""
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        before, state = state, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = written(_small(_large(now)), "links")
