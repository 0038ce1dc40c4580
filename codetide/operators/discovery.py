"""Which files of a corpus are kept, which are left out, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from codetide.functions.paths import DiscoveryRules, exclude_reasons
from codetide.functions.text import first_lines, readable


def classify(
    corpus: DataFrame, rules: DiscoveryRules = DiscoveryRules(), path: str = "file_path", text: Column | None = None
) -> DataFrame:
    """Add ``exclude_reasons`` (all that apply) and ``excluded``.

    Without ``text``, the header of the file's bytes is read as text, leaving out
    bytes that are not valid.
    """
    body = text if text is not None else readable(first_lines(F.col("content").cast("string"), rules.header_lines))
    return corpus.withColumn("exclude_reasons", exclude_reasons(F.col(path), body, rules)).withColumn(
        "excluded", F.size("exclude_reasons") > 0
    )


def summary(classified: DataFrame) -> DataFrame:
    """One row of totals."""
    return classified.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(~F.col("excluded")).alias("kept_files"),
        F.count_if("excluded").alias("excluded_files"),
    )


def reason_counts(classified: DataFrame) -> DataFrame:
    """Files per reason; a file counts once under each of its reasons."""
    return (
        classified.select(F.explode("exclude_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("files"))
    )


def kept(classified: DataFrame, path: str = "file_path") -> DataFrame:
    """Sorted kept paths, as rows: the list may be longer than one task can hold."""
    return classified.filter(~F.col("excluded")).select(path).orderBy(path)


def excluded(classified: DataFrame, path: str = "file_path") -> DataFrame:
    return classified.filter("excluded").select(path, "exclude_reasons").orderBy(path)
