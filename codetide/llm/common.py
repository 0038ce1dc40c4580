"""What several operators share: reading a table, the fold rule, global positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from codetide.session import StagingArea, stage

HELD_OUT = 2
# keys of a join that may go to every task: a few dozen MB there, whatever the corpus
BROADCAST_KEYS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def tasks(spark: SparkSession) -> int:
    """The number of pieces wherever a count has to be named: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(
    df: DataFrame, order: list, area: StagingArea, label: str = "numbered", position: str = "position", piece: str = "piece"
) -> DataFrame:
    """Stage ``df`` in ``order`` and give every row its ``position`` from 0, and its ``piece``.

    Rows are dealt by range of ``order`` into even pieces and sorted inside them; Spark's
    increasing id is then (piece, place in the piece).  What crosses from piece to piece is one
    count per piece, so no task ever holds more than its piece.  Rows that tie in every order
    column get neighbouring places in either order.
    """
    spread = df.repartitionByRange(tasks(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = stage(spread.withColumn("__id", F.monotonically_increasing_id()), label, area)
    placed = placed.withColumns(
        {piece: F.shiftright("__id", 33).cast("int"), "__place": F.col("__id").bitwiseAND((1 << 33) - 1)}
    ).drop("__id")
    counted = with_offset(placed, {position: F.count(F.lit(1))}, piece)
    return counted.withColumn(position, F.col(position) + F.col("__place")).drop("__place")


def with_offset(pieced: DataFrame, totals: dict[str, Column], piece: str = "piece") -> DataFrame:
    """Add, under each name, the total of an aggregate over all earlier pieces."""
    per_piece = pieced.groupBy(piece).agg(*[total.alias(f"__{n}") for n, total in totals.items()])
    # one row per piece: as many as the session has tasks, whatever the data
    before = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_piece.select(
        piece, *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(n) for n in totals]
    )
    return pieced.join(F.broadcast(offsets), piece)


def bounded(keys: DataFrame) -> DataFrame:
    """``keys``, a staged table, marked for a join: counted and broadcast up to ``BROADCAST_KEYS`` rows, merged beyond."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys.hint("merge")
