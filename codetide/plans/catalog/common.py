"""Table access and the SQL spelling of the id rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(expr: str) -> str:
    """A string part of an id, quoted as JSON."""
    return f"to_json(({expr})::varchar)::varchar"


def hash_sql(prefix: str, *parts: str) -> str:
    """The id of JSON-ready ``parts`` (wrap strings in ``text``, leave numbers bare)."""
    joined = " || ',' || ".join(f"({p})::varchar" for p in parts)
    return f"('{prefix}:' || sha256('[' || {joined} || ']'))"
