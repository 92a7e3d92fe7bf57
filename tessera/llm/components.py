"""Connected components by alternating large-star and small-star rounds.

Every round is written to the shared folder, so lost executors do not replay the earlier
ones, and replaces the round before.  A node of any degree is only pre-aggregated and joined, never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b); the component is its smallest node."""
    scratch = Scratch(edges.sparkSession)
    edges = scratch.put(edges.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct(), "edges")
    previous = None
    while True:
        both = _both(edges)
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.put(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = scratch.put(small.where("a <> b").distinct(), "small-star")
        scratch.drop("edges", "large-star")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == previous:
            break
        previous = state
    star = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return star.union(edges.select("b", "b").distinct().toDF("id", "component")).distinct()
