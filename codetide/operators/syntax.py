"""Nodes with ids, their properties, and syntax edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from codetide.contract import LANGUAGE
from codetide.functions import ids, symbols
from codetide.session import StagingArea, stage

FILE = ["repository", "file_path"]


def split_by_key(df: DataFrame, files: DataFrame, area: StagingArea | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of files whose key is their own, and rows of the others, None where there are none.

    ``files`` has a row per file.  Only in the first part does a place name one row.  Keys that
    several files share, or that hold a null, are few, if any; they are staged, so that Spark knows their size.
    """
    shared = files.groupBy(*FILE).count().filter("count > 1 or repository is null or file_path is null")
    shared = stage(shared.select(*[F.col(c).alias(f"__{c}") for c in FILE]), "shared-keys", area)
    if shared.isEmpty():
        return df, None
    same = F.col("repository").eqNullSafe(F.col("__repository")) & F.col("file_path").eqNullSafe(F.col("__file_path"))
    return df.join(shared, same, "left_anti"), df.join(shared, same, "left_semi")


def with_occurrence(df: DataFrame, group: list[str], order: list[str], name: str = "occurrence") -> DataFrame:
    """Running number, from zero, of a row among its like.

    The leading hash adds nothing to the grouping; it lets the sort decide nearly
    every comparison on eight bytes instead of a row of long texts.
    """
    window = Window.partitionBy(F.xxhash64(*group), *group).orderBy(*order)
    return df.withColumn(name, (F.row_number().over(window) - 1).cast("int"))


def identify(flat: DataFrame, hashed: bool = True) -> DataFrame:
    """Add ``node_id``, ``parent_id``, ``name`` and ``qualified_name``: a projection, no exchange.

    Unless ``hashed``, ids stay what they are made of (``ids.node_parts``).
    """
    c = F.col
    signature = symbols.signature(
        c("kind"), c("ident"), c("asname"), c("ctx"), c("value_type"), c("value_preview"), c("shape_hash")
    )
    an_id = (lambda *parts: ids.node_id(c("repository"), c("file_path"), *parts)) if hashed else ids.node_parts
    node = an_id(c("scope"), c("kind"), signature, c("occurrence"))
    # of parents that are names, the context is the child
    none = F.lit(None).cast("string")
    above = symbols.signature(
        c("parent_kind"), c("parent_ident"), none, c("kind"), none, none, c("parent_shape_hash")
    )
    parent = an_id(c("parent_scope"), c("parent_kind"), above, c("parent_occurrence"))
    return flat.withColumns(
        {
            "node_id": F.when(c("error").isNull(), node),
            "parent_id": F.when(c("parent_pos").isNotNull(), parent),
            "name": symbols.display_name(c("kind"), c("ident"), c("asname"), c("callee")),
            "qualified_name": F.when(
                c("kind").isin(*symbols.DEFINITIONS), symbols.qualified(c("scope"), c("ident"))
            ),
        }
    ).drop("shape_hash", "occurrence", "parent_scope", "parent_ident", "parent_shape_hash", "parent_occurrence")


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where ``right`` has one row per key.

    The keys are joined by their hash as well: it adds nothing to the result, and
    the sort before the merge then compares eight bytes, not several texts.
    """
    tag = F.xxhash64(*keys).alias("key_hash")
    return left.select("*", tag).join(right.select("*", tag), ["key_hash", *keys], how).drop("key_hash")


def node_properties() -> Column:
    """Typed properties of a syntax node; a field that does not apply is null."""
    kind = F.col("kind")
    constant = kind == "Constant"
    return F.struct(
        F.lit(LANGUAGE).alias("language"),
        F.col("qualified_name"),
        F.col("decorators"),
        F.when(constant, F.col("value_type")).alias("value_type"),
        F.when(constant, F.col("value_preview")).alias("value_preview"),
        F.when(kind == "Name", F.col("ctx")).alias("context"),
        F.lit(None).cast("boolean").alias("resolved"),
    )


def node_rows(rows: DataFrame) -> DataFrame:
    """Projection of identified rows to the shape of a node event."""
    return rows.filter(F.col("error").isNull()).select(
        *FILE,
        "pos",
        "node_id",
        F.col("kind").alias("node_type"),
        "name",
        "scope",
        "start_line",
        "end_line",
        "start_col",
        "end_col",
        node_properties().alias("properties"),
    )


def child_anchor(field: Column, idx: Column) -> Column:
    return F.when(idx.isNull(), field).otherwise(F.concat_ws(":", field, idx.cast("string")))


def link_parents(
    children: DataFrame,
    parents: DataFrame,
    on: dict[str, str],
    parent_id: str,
    as_name: str = "src_node_id",
) -> DataFrame:
    """Give each child its parent's id; ``on`` maps child key columns to parent key columns.

    The parent side has one row per key, so the join never multiplies rows.
    """
    keyed = parents.select(*[F.col(p).alias(c) for c, p in on.items()], F.col(parent_id).alias(as_name))
    return lookup(children, keyed, list(on))
