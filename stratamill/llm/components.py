"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.sinks.written import written_once


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v only, which is no u itself."""
    ends = edges.groupBy("u").agg(F.count("*").alias("n"), F.lit(0).alias("as_v"))
    tops = edges.select(F.col("v").alias("u")).distinct().select("u", F.lit(0).alias("n"), F.lit(1).alias("as_v"))
    both = ends.unionByName(tops).groupBy("u").agg(F.sum("n").alias("n"), F.max("as_v").alias("as_v"))
    return both.where("n > 1 or (n > 0 and as_v > 0)").isEmpty()


def _with_smallest(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m``, the smallest v of u; hot ends are folded on the map side."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) of every node in ``links`` (u, v).

    Self-links and nulls are ignored. Each round is written to the shared folder, which
    cuts the lineage; rounds grow with the logarithm of the longest path.
    """
    links = links.where("u is not null and v is not null and u <> v")
    edges = written_once(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u hangs on the smallest of u and its neighbours.
        large = _with_smallest(both).where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        # Small star: u and its smaller neighbours hang on the smallest of them.
        stars = _with_smallest(large)
        small = stars.select("u", F.col("m").alias("v")).unionByName(
            stars.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = written_once(small.distinct())
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
