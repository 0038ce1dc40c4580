"""Corpus to graph: parse once, derive the rest by joins and windows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide.operators.delta import error_rows
from codetide.functions import ids
from codetide.operators.calls import external_rows
from codetide.operators.edges import (
    COUNTED_COLUMNS, counted_kinds, described, external_symbols, file_metadata, finished, flow_edges, local_counts, own_children,
    split_rows, staged_counts,
)
from codetide.operators.flatten import flatten
from codetide.operators.syntax import FILE, identify, node_rows
from codetide.session import StagingArea, stage


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame
    metadata: DataFrame
    errors: DataFrame
    # (file key, what the ids are made of) of all nodes and edges: for who stores ids
    node_parts: DataFrame
    edge_parts: DataFrame


def identified_rows(corpus: DataFrame, spread: int | None = None) -> DataFrame:
    """Identified syntax rows, not yet computed: enough where a single branch reads them.

    Contents are shuffled only on request: ``spread`` is for a corpus that lies in too few tasks.
    """
    return identify(flatten(corpus, spread))


def parsed_rows(
    corpus: DataFrame,
    spread: int | None = None,
    area: StagingArea | None = None,
    only: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Identified syntax rows over a staged table, so that no branch parses again.

    The table holds what ids are made of, not the ids, which no codec makes smaller than their 32 bytes: each
    branch works out those it reads.  ``only`` chooses rows, where not all are asked for: the others are not written.
    """
    rows = flatten(corpus, spread)
    return identify(stage(rows if only is None else only(rows), "rows", area))


def parse_errors(rows: DataFrame) -> DataFrame:
    failed = rows.filter(F.col("error").isNotNull())
    # a file with no bytes at hand has no hash
    digest = F.when(F.col("size_bytes") > 0, F.col("content_sha256")).otherwise("")
    return error_rows(
        failed.select(
            *FILE,
            digest.alias("content_sha256"),
            F.col("error.type").alias("error_type"),
            F.col("error.message").alias("error_message"),
            F.col("error.classes").alias("error_classes"),
        )
    )


def extract(corpus: DataFrame, spread: int | None = None, area: StagingArea | None = None) -> Graph:
    """Nodes, edges, file metadata and errors of ``corpus(repository, file_path, content)``.

    Staged are syntax rows, the edges that more than one row has a part in, external symbols and metadata, all with
    what ids are made of, which is less than ids are; ids are worked out where they are read.
    """
    flat = stage(flatten(corpus, spread), "rows", area)
    own, shared = split_rows(identify(flat, hashed=False), area)
    # worked out once: counts, symbols and ids all read them
    flows = stage(flow_edges(own, shared, area), "flows", area)
    # a distinct over all edges, which every reader of nodes would repeat
    outside = stage(external_symbols(flows), "externals", area)
    return _graph(flat, own, shared, flows, outside, area)


def stored_graph(spark: SparkSession, area: StagingArea) -> Graph:
    """The graph of an earlier ``extract`` from the tables that it staged under an area of names."""
    flat, flows, outside, metadata = (area.read(spark, label) for label in ("rows", "flows", "externals", "metadata"))
    own, shared = split_rows(identify(flat, hashed=False))
    return _graph(flat, own, shared, flows, outside, None, metadata)


def _graph(
    flat: DataFrame, own: DataFrame, shared: DataFrame | None, flows: DataFrame, outside: DataFrame,
    area: StagingArea | None, metadata: DataFrame | None = None,
) -> Graph:
    c = F.col
    rows = identify(flat)
    parts = own_children(own).unionByName(flows)
    edges = finished(parts)
    symbol = ids.made(c("repository"), c("file_path"), c("dst_node_id"))
    nodes = node_rows(rows).unionByName(external_rows(outside.withColumn("dst_node_id", symbol)))
    if metadata is None:
        # counted once; every reader of the metadata would count nodes and edges again
        metadata = stage(_metadata(own, shared, flows, outside, nodes, edges), "metadata", area)
    sound = identify(flat, hashed=False).filter(c("error").isNull())
    return Graph(
        nodes,
        edges,
        metadata,
        parse_errors(flat),
        sound.select(*FILE, c("node_id").alias("made")).unionByName(outside.select(*FILE, c("dst_node_id").alias("made"))),
        parts.select(
            *FILE, F.struct("edge_type", "src_node_id", "dst_node_id", "anchor", "call_site").alias("made")
        ),
    )


def _facts(rows: DataFrame) -> DataFrame:
    """A row per file that could be parsed, of staged rows."""
    return rows.filter((F.col("pos") == 0) & F.col("error").isNull()).select(
        *FILE, "loc", "size_bytes", "content_sha256", "parse_duration_ms"
    )


def _metadata(
    own: DataFrame, shared: DataFrame | None, flows: DataFrame, outside: DataFrame, nodes: DataFrame, edges: DataFrame
) -> DataFrame:
    """Facts and counts of each file: from what is staged where a file's key is its own, else of the nodes and edges themselves."""
    counted = described(_facts(own).join(staged_counts(own, flows, outside), FILE, "left"))
    if shared is None:
        return counted
    keys = _facts(shared).select(*FILE).distinct()
    return counted.unionByName(file_metadata(_facts(shared), nodes.join(keys, FILE, "left_semi"), edges.join(keys, FILE, "left_semi")))


def file_counts(corpus: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """Facts and counts of each file of a corpus where a file's key is its own, without its nodes and edges."""
    rows = stage(flatten(corpus, columns=COUNTED_COLUMNS, keep=counted_kinds), "counted", area)
    return _facts(rows).join(local_counts(rows), FILE, "left")
