"""The event contract: names, schemas, envelope, routing, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# --- fixed values: the wire contract -------------------------------------------------
SCHEMA_VERSION = "1.0.0"
EXTRACTOR = "python-ast"
EXTRACTOR_VERSION = "1.0.0"
LANGUAGE = "python"

NODE_TOPIC = "cpg.node.events"
EDGE_TOPIC = "cpg.edge.events"
METADATA_TOPIC = "cpg.source.metadata.events"
ERROR_TOPIC = "cpg.parser.error.events"
DEAD_LETTER_TOPIC = "cpg.dead.letters"

NODE_UPSERT, NODE_DELETE = "node_upsert", "node_delete"
EDGE_UPSERT, EDGE_DELETE = "edge_upsert", "edge_delete"
SOURCE_UPSERT, PARSE_ERROR = "source_upsert", "parse_error"

EDGE_TYPES = ("AST_CHILD", "CFG", "DFG", "CALL")
PARTITIONS_PER_TOPIC = 3
RETENTION_DAYS = {NODE_TOPIC: 7, EDGE_TOPIC: 7, METADATA_TOPIC: 14, ERROR_TOPIC: 30}
MODULE_SCOPE = "<module>"
EXTERNAL_SCOPE = "<external>"
EXTERNAL_KIND = "ExternalSymbol"

# event type -> (topic, column holding the message key)
ROUTES = {
    NODE_UPSERT: (NODE_TOPIC, "file_path"),
    NODE_DELETE: (NODE_TOPIC, "file_path"),
    EDGE_UPSERT: (EDGE_TOPIC, "src_node_id"),
    EDGE_DELETE: (EDGE_TOPIC, "src_node_id"),
    SOURCE_UPSERT: (METADATA_TOPIC, "file_path"),
    PARSE_ERROR: (ERROR_TOPIC, "file_path"),
}

COUNTS = T.StructType(
    [
        T.StructField(name, T.IntegerType())
        for name in ("nodes", "edges", "ast_child_edges", "cfg_edges", "dfg_edges", "call_edges")
    ]
)

_ENVELOPE = [
    T.StructField("schema_version", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.StringType()),
]

# What the document view keeps of a metadata event; every other field is dropped.
METADATA_SCHEMA = T.StructType(
    [
        *_ENVELOPE,
        T.StructField("file_path", T.StringType()),
        T.StructField("repository", T.StringType()),
        T.StructField("loc", T.IntegerType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("content_sha256", T.StringType()),
        T.StructField("counts", COUNTS),
    ]
)

NODE_COLUMNS = (
    "node_type",
    "name",
    "file_path",
    "scope",
    "start_line",
    "end_line",
    "start_col",
    "end_col",
)

NODE_SCHEMA = T.StructType(
    [
        *_ENVELOPE,
        T.StructField("node_id", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in NODE_COLUMNS[:4]],
        *[T.StructField(name, T.IntegerType()) for name in NODE_COLUMNS[4:]],
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ]
)

EDGE_SCHEMA = T.StructType(
    [
        *_ENVELOPE,
        T.StructField("edge_id", T.StringType()),
        T.StructField("edge_type", T.StringType()),
        T.StructField("src_node_id", T.StringType()),
        T.StructField("dst_node_id", T.StringType()),
        T.StructField("file_path", T.StringType()),
    ]
)


# --- end of fixed values -------------------------------------------------------------


def event_time(ts: Column) -> Column:
    """ISO-8601 UTC text with milliseconds and a trailing Z (session zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def envelope(event_type: Column | str, time_text: Column) -> list[Column]:
    """The three leading fields of every event; ``time_text`` is already formatted."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    return [
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        time_text.alias("event_time"),
        kind.alias("event_type"),
    ]


def topic_of(event_type: Column, routes: dict = ROUTES) -> Column:
    """Topic for an event type; null for a type the contract does not know."""
    known = F.create_map(*[F.lit(x) for kind, (topic, _) in routes.items() for x in (kind, topic)])
    return F.try_element_at(known, event_type)


def key_of(event_type: Column, routes: dict = ROUTES, otherwise: str | None = None) -> Column:
    """Message key: the column the route names, else ``otherwise`` when that is null."""
    picked = F.lit(None).cast("string")
    for kind, (_, column) in routes.items():
        picked = F.when(event_type == kind, F.col(column).cast("string")).otherwise(picked)
    return F.coalesce(picked, F.col(otherwise)) if otherwise else picked


def key_partition(key: Column, partitions: int = PARTITIONS_PER_TOPIC) -> Column:
    """Partition number of a key, the same on every run and every engine.

    It is a column, not a placement: rows of a hot key stay spread over tasks
    and a reader restores their order from the sequence each event carries.
    """
    head = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(partitions)).cast("int")


def within_retention(time: Column, topic: Column, now: Column, days: dict = RETENTION_DAYS) -> Column:
    """True while an event is younger than its topic's window; unlisted topics never expire."""
    keep = F.lit(True)
    for name, width in days.items():
        keep = F.when(topic == name, time >= now - F.expr(f"INTERVAL {int(width)} DAYS")).otherwise(keep)
    return keep


def violations(events: DataFrame, types: tuple[str, ...] = tuple(ROUTES)) -> DataFrame:
    """Rows that break the contract; a healthy stream gives none."""
    good = (
        F.col("schema_version").eqNullSafe(SCHEMA_VERSION)
        & F.coalesce(F.col("event_time").endswith("Z"), F.lit(False))
        & F.coalesce(F.col("event_type").isin(*types), F.lit(False))
        & F.col("file_path").isNotNull()
    )
    return events.filter(~good)
