"""The four kinds of edges in one shape, and counts over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from codetide.contract import COUNTS, EDGE_TYPES
from codetide.functions import ids, symbols
from codetide.operators import calls as call_ops
from codetide.operators.control_flow import control_flow_edges, local_flow_edges
from codetide.operators.data_flow import data_flow_edges
from codetide.operators.syntax import FILE, child_anchor, link_parents, split_by_key
from codetide.session import StagingArea, stage

PROPERTY_TYPES = {
    "field": "string",
    "index": "int",
    "branch": "string",
    "variable": "string",
    "flow": "string",
    "target": "string",
    "call_site_node_id": "string",
    "call_line": "int",
}


def edge_properties(**present: Column) -> Column:
    """Typed edge properties; the ones a kind does not use are null."""
    return F.struct(
        *[
            present.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in PROPERTY_TYPES.items()
        ]
    )


def deduplicate(edges: DataFrame, within: list[str] | None = None) -> DataFrame:
    """One row per edge id.  Equal ids carry equal payloads, so any copy will do."""
    return edges.dropDuplicates([*(within or []), "edge_id"])


def _child_columns() -> list:
    c = F.col
    return [
        *FILE,
        F.lit("AST_CHILD").alias("edge_type"),
        c("node_id").alias("dst_node_id"),
        child_anchor(c("field"), c("idx")).alias("anchor"),
        edge_properties(field=c("field"), index=c("idx")).alias("properties"),
        F.lit(False).alias("is_external"),
    ]


def child_edges(sound: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """AST_CHILD edges: each row carries its parent's id.

    Only where several files share a repository and path, parents are looked up by
    their place, in all of those files; such keys are few, if any, and staged, so that Spark knows their size.
    """
    c = F.col
    children = sound.filter(c("parent_pos").isNotNull())
    repeated = stage(sound.filter(c("pos") == 0).groupBy(*FILE).count().filter("count > 1").select(*FILE), "repeated", area)
    named = children.filter(c("repository").isNotNull() & c("file_path").isNotNull())
    once = named.join(repeated, FILE, "left_anti").select(*_child_columns(), c("parent_id").alias("src_node_id"))
    several = link_parents(
        children.join(repeated, FILE, "left_semi").select(*_child_columns(), c("parent_pos").alias("src_pos")),
        sound.join(repeated, FILE, "left_semi"),
        {"repository": "repository", "file_path": "file_path", "src_pos": "pos"},
        "node_id",
    ).drop("src_pos")
    return once.unionByName(several)


def all_edges(rows: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """AST_CHILD, CFG, DFG and CALL edges of identified rows.

    Call edges know their caller only as a position and look it up among the few rows
    that can own a call.  Each visit, branch, use and call site yields its edges once, so
    the union holds no id twice and needs no further shuffle to drop repeats.  Nothing is
    staged but the keys that several files share: a reader that needs no ids makes none.
    """
    own, shared = split_rows(rows, area)
    return finished(own_children(own).unionByName(flow_edges(own, shared, area)))


def split_rows(rows: DataFrame, area: StagingArea | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the files that could be parsed, by whether a file's key is its own."""
    sound = rows.filter(F.col("error").isNull())
    return split_by_key(sound, sound.filter("pos = 0"), area)


def flow_edges(own: DataFrame, shared: DataFrame | None, area: StagingArea | None = None) -> DataFrame:
    """All edges that more than one row has a part in, not ``finished``: CFG, DFG and CALL edges, and of shared keys all."""
    edges = _edges(own, area, local=True)
    return edges if shared is None else edges.unionByName(_edges(shared, area, local=False))


def finished(edges: DataFrame) -> DataFrame:
    """Edges with their ids; ends that are ``ids.node_parts`` become ids as well."""
    c = F.col
    if isinstance(edges.schema["src_node_id"].dataType, T.StructType):
        ends = ("src_node_id", "dst_node_id", "call_site")
        edges = edges.withColumns({end: ids.made(c("repository"), c("file_path"), c(end)) for end in ends})
    return edges.select(
        *FILE,
        ids.edge_id(c("edge_type"), c("src_node_id"), c("dst_node_id"), F.coalesce("call_site", "anchor")).alias("edge_id"),
        "edge_type",
        "src_node_id",
        "dst_node_id",
        c("properties").withField("call_site_node_id", c("call_site")).alias("properties"),
        "is_external",
    )


def own_children(own: DataFrame) -> DataFrame:
    """AST_CHILD edges, not ``finished``, of files whose key is their own: a projection."""
    children = own.filter(F.col("parent_pos").isNotNull()).select(*_child_columns(), F.col("parent_id").alias("src_node_id"))
    return children.withColumn("call_site", F.lit(None).cast(own.schema["node_id"].dataType))


def _local_flows(sound: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Control-flow and data-flow edges of files whose key is their own; ids, where they are made, are shuffled as 32 bytes."""
    if isinstance(sound.schema["node_id"].dataType, T.StructType):
        return local_flow_edges(sound), data_flow_edges(sound)
    packed = sound.withColumn("node_id", F.unhex(F.substring("node_id", 3, 64)))
    text = lambda name: F.concat(F.lit("n:"), F.lower(F.hex(name))).alias(name)
    whole = lambda flow, *more: flow.select(*FILE, "edge_type", text("src_node_id"), text("dst_node_id"), "anchor", *more)
    return whole(local_flow_edges(packed), "branch"), whole(data_flow_edges(packed), "variable")


def _edges(sound: DataFrame, area: StagingArea | None, local: bool) -> DataFrame:
    c = F.col
    calls = call_ops.resolved_calls(sound).select(
        *FILE,
        F.lit("CALL").alias("edge_type"),
        c("owner_pos").alias("src_pos"),
        "dst_node_id",
        F.lit(None).cast("string").alias("anchor"),
        c("node_id").alias("call_site"),
        edge_properties(target=c("target"), call_line=c("start_line")).alias("properties"),
        "is_external",
    )
    called = link_parents(
        calls,
        call_ops.owners(sound),
        {"repository": "repository", "file_path": "file_path", "src_pos": "pos"},
        "node_id",
    ).drop("src_pos")
    control, data = _local_flows(sound) if local else (control_flow_edges(sound), data_flow_edges(sound))
    flows = control.withColumn(
        "properties", edge_properties(branch=c("branch"))
    ).drop("branch").unionByName(
        data
        .withColumn("properties", edge_properties(variable=c("variable"), flow=F.lit("DEF_USE")))
        .drop("variable")
    )
    edges = called.unionByName(flows.withColumn("is_external", F.lit(False)), allowMissingColumns=True)
    return edges if local else edges.unionByName(child_edges(sound, area), allowMissingColumns=True)


def external_symbols(edges: DataFrame) -> DataFrame:
    """The symbols that call edges reach outside their file, once each: what ``external_rows`` takes."""
    return edges.filter("is_external").select(*FILE, "dst_node_id", F.col("properties.target").alias("target")).distinct()


def count_by_type(
    edges: DataFrame, keys: list[str], edge_type: str = "edge_type", types: tuple[str, ...] = EDGE_TYPES
) -> DataFrame:
    """One row per key: total edges and one zero-filled column per type."""
    return edges.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("edges"),
        *[F.count_if(F.col(edge_type) == t).cast("int").alias(f"{t.lower()}_edges") for t in types],
    )


def counted_kinds(row: dict) -> bool:
    """Rows of the flattener that ``local_counts`` reads: statements, calls, and what defines or uses a variable."""
    return row["pos"] == 0 or row["path"] is not None or row["imports"] is not None or row["kind"] in _COUNTED


_COUNTED = frozenset(("Call", "Name", "arg", *call_ops.OWNERS, *symbols.DEFINITIONS))
COUNTED_COLUMNS = [
    *FILE, "pos", "parent_pos", "parent_kind", "field", "idx", "kind", "ident", "ctx", "callee", "imports", "scope", "owner_pos",
    "stmt_pos", "flow_scope_pos", "flow_ok", "is_last", "has_else", "has_final", "path", "start_line", "start_col",
    "content_sha256", "loc", "size_bytes", "parse_duration_ms", "n_visits", "error",
]


def local_counts(rows: DataFrame) -> DataFrame:
    """Nodes, edges and edges by type of files whose key is their own, from positions alone: no id is made.

    ``rows`` are staged and hold at least ``counted_kinds``; a file's first row knows how many visits it had.
    """
    c, zero = F.col, F.lit(0)
    rows = rows.filter(c("error").isNull())
    rows = rows.withColumns({"node_id": c("kind"), "qualified_name": symbols.qualified(c("scope"), c("ident"))})

    def part(df: DataFrame, **counts: Column) -> DataFrame:
        names = ("nodes", *[f"{t.lower()}_edges" for t in EDGE_TYPES])
        return df.select(*FILE, *[counts.get(n, zero).cast("int").alias(n) for n in names])

    one = F.lit(1)
    calls = call_ops.resolved_calls(rows).groupBy(*FILE).agg(
        F.count(one).alias("n"), F.count_distinct(F.when(c("is_external"), c("target"))).alias("symbols")
    )
    parts = part(rows.filter("pos = 0"), nodes=c("n_visits"), ast_child_edges=c("n_visits") - 1)
    parts = parts.unionByName(part(calls, nodes=c("symbols"), call_edges=c("n")))
    parts = parts.unionByName(part(local_flow_edges(rows), cfg_edges=one)).unionByName(part(data_flow_edges(rows), dfg_edges=one))
    types = [f"{t.lower()}_edges" for t in EDGE_TYPES]
    summed = parts.groupBy(*FILE).agg(*[F.sum(n).cast("int").alias(n) for n in ("nodes", *types)])
    return summed.withColumn("edges", sum((c(t) for t in types[1:]), c(types[0])))


def staged_counts(own: DataFrame, flows: DataFrame, externals: DataFrame) -> DataFrame:
    """``local_counts`` where edges and external symbols are staged already; other files' rows among them do no harm to a left join."""
    c, types = F.col, [f"{t.lower()}_edges" for t in EDGE_TYPES]

    def part(df: DataFrame, **counts: Column) -> DataFrame:
        return df.select(*FILE, *[counts.get(n, F.lit(0)).cast("int").alias(n) for n in ("nodes", *types)])

    parts = part(own.filter("pos = 0"), nodes=c("n_visits"), ast_child_edges=c("n_visits") - 1)
    parts = parts.unionByName(part(externals, nodes=F.lit(1)))
    parts = parts.unionByName(part(flows, **{n: F.when(c("edge_type") == t, 1).otherwise(0) for n, t in zip(types, EDGE_TYPES)}))
    summed = parts.groupBy(*FILE).agg(*[F.sum(n).cast("int").alias(n) for n in ("nodes", *types)])
    return summed.withColumn("edges", sum((c(t) for t in types[1:]), c(types[0])))


def file_metadata(files: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Facts of each file with a ``counts`` struct, zero where there is nothing."""
    node_counts = nodes.groupBy(*FILE).agg(F.count(F.lit(1)).cast("int").alias("nodes"))
    return described(files.join(node_counts, FILE, "left").join(count_by_type(edges, FILE), FILE, "left"))


def described(counted: DataFrame) -> DataFrame:
    """Metadata rows of files with their counts beside their facts."""
    counts = F.struct(*[F.coalesce(F.col(f.name), F.lit(0)).alias(f.name) for f in COUNTS])
    return counted.select(
        *FILE,
        ids.file_id(F.col("repository"), F.col("file_path")).alias("file_id"),
        "loc",
        "size_bytes",
        "content_sha256",
        "parse_duration_ms",
        counts.alias("counts"),
    )
