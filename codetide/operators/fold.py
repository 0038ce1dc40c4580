"""Folding change events into current views.

Every fold is a set of max/max_by aggregates over one total order, so it does
not care in which order events arrive, how often they are repeated, or how they
are split into batches; a hot id costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from codetide import contract
from codetide.functions import ids
from codetide.session import StagingArea, stage

ATTRIBUTES = [*contract.NODE_COLUMNS, "updated_at"]
EDGE_ATTRIBUTES = ["src_node_id", "dst_node_id", "edge_type", "file_path", "updated_at"]


def order_of(columns: list[str]) -> Column:
    return F.struct(*columns)


# --- latest row per key ---------------------------------------------------------------
def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole last row of each key under ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_of(order)).alias("row"))
    return best.select(*keys, "row.*").select(*df.columns)


def replace_documents(
    stored: DataFrame | None, arrived: DataFrame, key: str, order: list[str], keep: list[str] | None = None
) -> DataFrame:
    """Replace by key: an arrival beats the stored row whole; among arrivals the last wins.

    ``order`` ranks arrivals; ``keep`` names the document's columns besides the
    key (all of them by default).  One shuffle joins old and new.
    """
    keep = keep or [c for c in arrived.columns if c != key]
    rows = arrived.select(key, order_of(order).alias("rank"), F.struct(*keep).alias("doc"))
    if stored is not None:
        # a null rank is only ever read where no arrival has one
        rank = F.lit(None).cast(rows.schema["rank"].dataType).alias("rank")
        rows = rows.unionByName(stored.select(key, rank, F.struct(*keep).alias("doc")))
    merged = rows.groupBy(key).agg(
        F.max_by("doc", "rank").alias("fresh"),
        F.any_value(F.when(F.col("rank").isNull(), F.col("doc")), ignoreNulls=True).alias("old"),
    )
    return merged.select(key, F.coalesce("fresh", "old").alias("doc")).select(key, "doc.*")


# --- accumulators ---------------------------------------------------------------------
def node_accumulators(node_events: DataFrame, edge_events: DataFrame | None, order: list[str]) -> DataFrame:
    """Per node: last upsert with its columns, last delete, last time an edge touched it.

    An event of any type other than the upsert counts as a delete.
    """
    c = F.col
    seq = order_of(order)
    is_upsert = F.coalesce(c("event_type") == contract.NODE_UPSERT, F.lit(False))
    attributes = F.struct(*[c(n) for n in contract.NODE_COLUMNS], c("event_time").alias("updated_at"))
    facts = node_events.filter(c("node_id").isNotNull()).select(
        "node_id",
        F.when(is_upsert, seq).alias("upsert_seq"),
        F.when(~is_upsert, seq).alias("delete_seq"),
        F.when(is_upsert, attributes).alias("attributes"),
    )
    if edge_events is not None:
        touched = (
            edge_events.filter(c("event_type") == contract.EDGE_UPSERT)
            .select(seq.alias("touch_seq"), F.explode(F.array("src_node_id", "dst_node_id")).alias("node_id"))
            .filter(c("node_id").isNotNull())
        )
        facts = facts.unionByName(touched, allowMissingColumns=True)
    else:
        facts = facts.withColumn("touch_seq", F.lit(None).cast(facts.schema["upsert_seq"].dataType))
    return merge_node_accumulators(facts)


def merge_node_accumulators(parts: DataFrame) -> DataFrame:
    merged = parts.withColumn("node_id", ids.packed(F.col("node_id"))).groupBy("node_id").agg(
        F.max("upsert_seq").alias("upsert_seq"),
        F.max("delete_seq").alias("delete_seq"),
        F.max("touch_seq").alias("touch_seq"),
        F.max_by("attributes", "upsert_seq").alias("attributes"),
    )
    return merged.withColumn("node_id", ids.unpacked(F.col("node_id")))


def node_deletes(node_events: DataFrame, order: list[str]) -> DataFrame:
    """Last delete per node, straight from the events that delete."""
    is_upsert = F.coalesce(F.col("event_type") == contract.NODE_UPSERT, F.lit(False))
    gone = node_events.filter(~is_upsert & F.col("node_id").isNotNull())
    return gone.groupBy("node_id").agg(F.max(order_of(order)).alias("delete_seq"))


def accumulated_deletes(accumulated: DataFrame) -> DataFrame:
    """The same from node accumulators."""
    return accumulated.filter(F.col("delete_seq").isNotNull()).select("node_id", "delete_seq")


def edge_accumulators(edge_events: DataFrame, order: list[str]) -> DataFrame:
    c = F.col
    seq = order_of(order)
    is_upsert = F.coalesce(c("event_type") == contract.EDGE_UPSERT, F.lit(False))
    attributes = F.struct(
        "src_node_id", "dst_node_id", "edge_type", "file_path", c("event_time").alias("updated_at")
    )
    facts = edge_events.filter(c("edge_id").isNotNull()).select(
        "edge_id",
        seq.alias("seq"),
        F.struct(is_upsert.alias("live"), attributes.alias("attributes")).alias("last"),
    )
    return merge_edge_accumulators(facts)


def merge_edge_accumulators(parts: DataFrame) -> DataFrame:
    merged = parts.withColumn("edge_id", ids.packed(F.col("edge_id"))).groupBy("edge_id")
    merged = merged.agg(F.max("seq").alias("seq"), F.max_by("last", "seq").alias("last"))
    return merged.withColumn("edge_id", ids.unpacked(F.col("edge_id")))


def property_accumulators(node_events: DataFrame, order: list[str]) -> DataFrame:
    """Per node and property key: the last value written."""
    upserts = node_events.filter((F.col("event_type") == contract.NODE_UPSERT) & F.col("node_id").isNotNull())
    entries = upserts.select(
        "node_id", order_of(order).alias("seq"), F.explode("properties").alias("property", "value")
    )
    return merge_property_accumulators(entries)


def merge_property_accumulators(parts: DataFrame) -> DataFrame:
    return parts.groupBy("node_id", "property").agg(
        F.max("seq").alias("seq"), F.max_by("value", "seq").alias("value")
    )


# --- views ----------------------------------------------------------------------------
def node_view(accumulated: DataFrame) -> DataFrame:
    """Nodes that exist: upserted, or touched by an edge, since their last delete.

    A node known only from edges is a stub, with its id and nothing else.
    """
    c = F.col
    upserted = c("upsert_seq").isNotNull() & (c("delete_seq").isNull() | (c("upsert_seq") > c("delete_seq")))
    touched = c("touch_seq").isNotNull() & (c("delete_seq").isNull() | (c("touch_seq") > c("delete_seq")))
    return accumulated.filter(upserted | touched).select(
        "node_id",
        *[F.when(upserted, c(f"attributes.{n}")).alias(n) for n in ATTRIBUTES],
        (~upserted).alias("is_stub"),
    )


def live_properties(properties: DataFrame, deletes: DataFrame) -> DataFrame:
    """Merged properties: last value per key since the node's last delete; null removes.

    ``properties`` is already down to one row per node and key.
    """
    return (
        properties.join(deletes, "node_id", "left")
        .filter(F.col("value").isNotNull() & (F.col("delete_seq").isNull() | (F.col("seq") > F.col("delete_seq"))))
        .select("node_id", "property", "value")
    )


def edge_view(edges: DataFrame, deletes: DataFrame, salts: int = 8) -> DataFrame:
    """Edges whose last event is an upsert newer than any delete of either end.

    Only deleted nodes can end an edge, so only they are looked up.  A hub may be
    an end of very many edges: each side of the lookup is spread over ``salts``
    sub-keys, which keeps one hub from landing in one task.
    """
    c = F.col
    salt = F.pmod(F.xxhash64("edge_id"), F.lit(salts)).cast("int")
    live = edges.filter("last.live").select("edge_id", "seq", "last.attributes.*").withColumn("salt", salt)
    spread = deletes.select(
        "node_id", "delete_seq", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("salt")
    )
    for end in ("src_node_id", "dst_node_id"):
        gone = spread.select(c("node_id").alias(end), "salt", c("delete_seq").alias("end_delete_seq"))
        live = live.join(gone, [end, "salt"], "left").filter(
            c("end_delete_seq").isNull() | (c("seq") > c("end_delete_seq"))
        ).drop("end_delete_seq")
    return live.select("edge_id", *EDGE_ATTRIBUTES)


def graph_view(node_events: DataFrame, edge_events: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Current nodes and edges of two event streams under one total order."""
    nodes = node_accumulators(node_events, edge_events, order)
    edges = edge_accumulators(edge_events, order)
    return node_view(nodes), edge_view(edges, node_deletes(node_events, order))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row; a view with unique keys gives none."""
    return _counted(df, key)


def rare_duplicates(df: DataFrame, key: list[str], area: StagingArea | None = None) -> DataFrame:
    """``duplicates`` where few or none are expected: eight bytes a key are shuffled, whole keys only where those repeat."""
    tag = F.xxhash64(*key).alias("tag")
    tags = stage(df.select(tag).groupBy("tag").count().filter("count > 1").select("tag"), "tags", area)
    if tags.isEmpty():
        return _counted(df.filter(F.lit(False)), key)
    return _counted(df.select("*", tag).join(tags, "tag", "left_semi"), key)


def _counted(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
