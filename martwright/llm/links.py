"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Connect a node's neighbours to the smallest of them: the larger ones, or (small) the others."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else both.filter("b < a")
    lowest = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    joined = around.join(lowest, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            lowest.select("a", F.col("low").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of a link table ``a, b``; the root is the component's smallest node.

    Links stay a table throughout; each step is a grouping (collapsed map-side, so a hub with very many
    links is no group in memory) and a join, and its result is written to the shared folder. The number of
    steps grows with the logarithm of the longest chain. NULL nodes and links of a node to itself are left out.
    """
    clean = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = materialize(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        edges = materialize(_stars(_stars(edges, large=True), large=False), "stars")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == state:
            break
        state = (now["n"], now["h"])
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
