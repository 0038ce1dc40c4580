"""Reconciliation and lookup queries over logs and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from codetide.contract import EDGE_TYPES, EXTERNAL_KIND
from codetide.operators.edges import count_by_type


def totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: how many nodes and edges there are."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    return one(nodes, "nodes").unionByName(one(edges, "edges"))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of each key; Spark cuts each task to ``k`` per key before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def first_rows(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """An ordered sample of ``k`` rows, kept as a running top-k in each task."""
    return df.orderBy(*order).limit(k)


def reconcile(before: DataFrame, removed: DataFrame, added: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: before - removed + added = after, and whether it holds.

    The four inputs are rows of ids; each is counted on the map side.
    """
    parts = {"before": before, "removed": removed, "added": added, "after": after}
    tagged = None
    for name, df in parts.items():
        part = df.select(*keys, *[F.lit(1 if n == name else 0).alias(n) for n in parts])
        tagged = part if tagged is None else tagged.unionByName(part)
    summed = tagged.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in parts])
    balance = F.col("before") - F.col("removed") + F.col("added")
    return summed.withColumn("balanced", balance == F.col("after"))


def cross_view(metadata: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Files whose edge counts by type differ between metadata and graph."""
    counted = count_by_type(edges, keys)
    names = ["edges", *[f"{t.lower()}_edges" for t in EDGE_TYPES]]
    both = metadata.select(*keys, *[F.col(f"counts.{n}").alias(f"said_{n}") for n in names]).join(
        counted, keys, "full_outer"
    )
    differs = F.lit(False)
    for n in names:
        differs = differs | (F.coalesce(f"said_{n}", F.lit(0)) != F.coalesce(n, F.lit(0)))
    return both.filter(differs)


def tree_invariant(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Per file: child edges must equal nodes less external symbols less the root."""
    node_part = nodes.select(
        *keys,
        F.when(F.col("node_type") == EXTERNAL_KIND, 0).otherwise(1).alias("inner"),
        F.lit(0).alias("child_edges"),
    )
    edge_part = edges.filter(F.col("edge_type") == "AST_CHILD").select(
        *keys, F.lit(0).alias("inner"), F.lit(1).alias("child_edges")
    )
    summed = node_part.unionByName(edge_part).groupBy(*keys).agg(
        F.sum("inner").alias("inner"), F.sum("child_edges").alias("child_edges")
    )
    return summed.withColumn("holds", F.col("child_edges") == F.col("inner") - 1)


def missing_topics(expected: DataFrame, log: DataFrame, topic: str = "topic") -> DataFrame:
    """Expected topics and whether the log holds any message of them."""
    present = log.select(topic).distinct().withColumn("present", F.lit(True))
    return expected.join(present, topic, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def batch_deltas(log: DataFrame, batch: str = "batch_id", parts: list[str] | None = None) -> DataFrame:
    """Messages each batch added, per partition if asked."""
    return log.groupBy(batch, *(parts or [])).agg(F.count(F.lit(1)).alias("messages"))
