"""What changed since the last run: skipping, removed ids, errors, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from codetide.functions import ids
from codetide.functions.text import error_stage
from codetide.operators.syntax import FILE

SUCCEEDED, FAILED, SKIPPED = "succeeded", "failed", "skipped"


def compare_content(corpus: DataFrame, state: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Key, hash and ``unchanged`` of each file.

    Only keys and hashes are shuffled; contents are hashed where they are read.
    ``state`` has the keys and ``content_sha256`` of the last good run.
    """
    now = corpus.select(*keys, ids.content_sha256(F.col("content")).alias("content_sha256"))
    before = state.select(*keys, F.col("content_sha256").alias("previous_sha256"))
    return now.join(before, keys, "left").withColumn(
        "unchanged", F.coalesce(F.col("content_sha256") == F.col("previous_sha256"), F.lit(False))
    )


def changed_only(corpus: DataFrame, compared: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Files still to be parsed.  When few changed, Spark broadcasts their keys by
    measured size and the contents are never shuffled."""
    return corpus.join(compared.filter(~F.col("unchanged")).select(*keys), keys, "left_semi")


def removed_ids(old: DataFrame, current: DataFrame, key: list[str], processed: DataFrame | None = None,
                processed_on: list[str] = FILE) -> DataFrame:
    """Rows of ``old`` whose id is gone, for files that were processed in this run."""
    candidates = old if processed is None else old.join(
        processed.select(*processed_on), processed_on, "left_semi"
    )
    return candidates.join(current.select(*key), key, "left_anti")


def added_ids(old: DataFrame, current: DataFrame, key: list[str]) -> DataFrame:
    return current.join(old.select(*key), key, "left_anti")


def error_rows(failures: DataFrame) -> DataFrame:
    """Error events from ``(file key, content_sha256, error_type, error_message, error_classes)``."""
    c = F.col
    staged = failures.withColumn("stage", error_stage(c("error_classes")))
    return staged.select(
        *FILE,
        ids.error_id(
            c("repository"), c("file_path"), c("content_sha256"), c("stage"), c("error_type"), c("error_message")
        ).alias("error_id"),
        "content_sha256",
        "error_type",
        "error_message",
        "stage",
        F.lit("error").alias("severity"),
        ids.stack_hash(c("error_type"), c("error_message"), c("stage")).alias("stack_hash"),
    )


def file_outcomes(
    metadata: DataFrame,
    removed_nodes: DataFrame,
    removed_edges: DataFrame,
    errors: DataFrame,
    skipped: DataFrame | None = None,
) -> DataFrame:
    """One row per file: status, counts, deletions, error text.

    Every input is first reduced to rows of the same shape, then one aggregate
    adds them up; removed ids combine on the map side.
    """
    number = lambda column: column.cast("bigint")
    zero = F.lit(0).cast("bigint")

    def part(df: DataFrame, status: str | None = None, error: Column | None = None, **counts: Column) -> DataFrame:
        names = ("nodes", "edges", "deleted_nodes", "deleted_edges")
        return df.select(
            *FILE,
            F.lit(status).cast("string").alias("status"),
            *[number(counts[n]).alias(n) if n in counts else zero.alias(n) for n in names],
            (error if error is not None else F.lit(None).cast("string")).alias("error"),
        )

    parts = part(metadata, SUCCEEDED, nodes=F.col("counts.nodes"), edges=F.col("counts.edges"))
    parts = parts.unionByName(part(removed_nodes, deleted_nodes=F.lit(1)))
    parts = parts.unionByName(part(removed_edges, deleted_edges=F.lit(1)))
    parts = parts.unionByName(part(errors, FAILED, F.col("error_message")))
    if skipped is not None:
        parts = parts.unionByName(part(skipped, SKIPPED))
    return parts.groupBy(*FILE).agg(
        F.max("status").alias("status"),
        F.sum("nodes").alias("nodes"),
        F.sum("edges").alias("edges"),
        F.sum("deleted_nodes").alias("deleted_nodes"),
        F.sum("deleted_edges").alias("deleted_edges"),
        F.max("error").alias("error"),
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row: files by status, sums, and whether any file failed."""
    status = F.col("status")
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return outcomes.agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(status == SUCCEEDED).alias("succeeded"),
        F.count_if(status == FAILED).alias("failed"),
        F.count_if(status == SKIPPED).alias("skipped"),
        total("nodes"),
        total("edges"),
        total("deleted_nodes"),
        total("deleted_edges"),
        F.coalesce(F.bool_or(status == FAILED), F.lit(False)).alias("run_failed"),
    )
