"""Connected components by alternating large-star and small-star rounds on DataFrames.

Every round replaces edges by edges to smaller neighbours until each component is a star around its
smallest node.  A round is a minimum per node (combined on the map side) joined back to the edges; a
node with very many edges is the side of a join that run-time skew handling may split.  Rounds are
written to the shared folder, so the lineage stays short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codetide.session import StagingArea, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _smallest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest neighbour of u, which may be u itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("__u"), F.least("__u", "m").alias("m"))
    return edges.join(least, F.col("u") == F.col("__u")).drop("__u")


def components(links: DataFrame) -> tuple[DataFrame, StagingArea]:
    """For every node of ``links`` (a, b): node and the root, the smallest node it is connected to.

    The second value is the folder the result lies in, to be released by the caller.
    """
    spark = links.sparkSession
    area = StagingArea(spark)
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stage(edges, "links", area), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _smallest(large)
        moved = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = StagingArea(spark)
        edges = stage(small.select("u", F.col("m").alias("v")).union(moved).distinct(), "round", following)
        now = _state(edges)
        area.release()
        area = following
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.union(roots).select(F.col("u").alias("node"), F.col("v").alias("root")), area
