"""Connected components of a table of edges, by stars that shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from farelane.session import save_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for each node of ``edges`` (``u``, ``v``).

    Every round is written to the shared folder, which cuts the lineage and survives lost executors, and
    observed while it is written: a round without change is the last.
    A node with many edges is combined before it is shuffled, and ends as the centre of its star.
    """
    state = None
    now = save_table(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    while True:
        seen, digest = Observation(), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        moved = _small_star(_large_star(now)).observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest"))
        now, before, state = save_table(moved, "edges"), state, seen.get
        if state == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
