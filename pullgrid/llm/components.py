"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullgrid.llm.common import written


def _stars(edges: DataFrame) -> DataFrame:
    """(u, v, low) of every edge; low: the least of u and its neighbours."""
    lows = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return edges.join(lows, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    stars = _stars(both).where("v > u")
    return stars.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _stars(down)
    ends = stars.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
        stars.select("u", F.col("low").alias("v"))
    )
    return ends.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every linked node; label: the least node of its component.

    ``links``: (u, v) pairs of numbers. A star's centre may have any number of
    neighbours: its minimum is aggregated before the shuffle, and the join back is one
    that Spark splits. Rounds are written to the shared folder and end when a round
    changes nothing, which is told by a count and a sum over the edges.
    """
    edges = links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v").distinct()
    edges, before = written(edges, "links"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        edges = written(_small_star(_large_star(edges)), "links")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return members.unionByName(centres)
