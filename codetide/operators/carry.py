"""Order-dependent values within a key, without putting a key in one task.

A window over a key that holds a third of all rows would sort that third in one
task.  Here rows are range-partitioned by (key, order) once, so every piece is of
even size however skewed the keys are and however many rows share an instant.
While a piece is staged, in order, a pass over it finds what its own rows give; no
second shuffle puts the rows together again.  What must cross into a piece from the
ones beside it is one row per (key, piece), combined on the map side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from codetide.session import StagingArea, stage

# executors get this module inside the task, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _same_as_before(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """For each row but the first: whether its key is that of the row before; nulls are alike."""
    same = np.ones(max(batch.num_rows - 1, 0), bool)
    for key in keys:
        column = batch.column(key)
        now, before = column.slice(1), column.slice(0, len(column) - 1)
        alike = pc.or_(pc.fill_null(pc.equal(now, before), False), pc.and_(pc.is_null(now), pc.is_null(before)))
        same &= alike.to_numpy(zero_copy_only=False)
    return same


def _fill(keys: list[str], names: list[str]):
    """Add, to rows in order, the nearest value above each row within its key; the row's own value is not seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end: pa.RecordBatch | None = None  # the last row seen, and per name the value that stands there
        held: dict[str, pa.Scalar] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.arange(batch.num_rows)
            goes_on = False
            if end is not None:
                pair = pa.Table.from_batches([end.select(keys), batch.slice(0, 1).select(keys)]).combine_chunks().to_batches()[0]
                goes_on = bool(_same_as_before(pair, keys)[0])
            begins = np.concatenate(([not goes_on], ~_same_as_before(batch, keys)))
            # where the row's key begins in this batch; -1 if it began in an earlier one
            first = np.maximum.accumulate(np.where(begins, place, -1))
            added = []
            for name in names:
                column = batch.column(f"in_{name}")
                filled = column.is_valid().to_numpy(zero_copy_only=False)
                nearest = np.maximum.accumulate(np.where(filled, place, -1))
                above = np.concatenate(([-1], nearest[:-1]))
                here = (above >= 0) & (above >= first)
                values = column.take(pa.array(np.where(here, above, 0), mask=~here))
                earlier = ~here & (first < 0)
                if earlier.any() and held[name].is_valid:
                    values = pc.if_else(pa.array(earlier), held[name], values)
                added.append(values)
                if nearest[-1] >= 0 and nearest[-1] >= first[-1]:
                    held[name] = column[int(nearest[-1])]
                elif first[-1] >= 0:
                    held[name] = pa.scalar(None, column.type)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *[f"local_{n}" for n in names]])
            end = batch.slice(batch.num_rows - 1)

    return run


def carry(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Column],
    forward: bool = True,
    pieces: int | None = None,
    area: StagingArea | None = None,
) -> DataFrame:
    """Per row, the nearest earlier (``forward``) or later non-null value of each expression.

    The row's own value is not seen.  Hand over only the columns that are needed: all of
    them are staged once, for as long as ``area`` lasts.  ``pieces`` is at least the
    number of tasks wanted for the whole data.
    """
    count = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = df.withColumns({f"in_{name}": value for name, value in values.items()})
    by = [F.col(c).asc() if forward else F.col(c).desc() for c in order]
    spread = named.repartitionByRange(count, *keys, *order).withColumn("piece", F.spark_partition_id())
    sorted_ = spread.sortWithinPartitions(*keys, *by)
    schema = T.StructType([*sorted_.schema, *[T.StructField(f"local_{n}", named.schema[f"in_{n}"].dataType) for n in values]])
    local = stage(sorted_.mapInArrow(_fill(keys, list(values)), schema), "pieces", area)

    rank = F.struct(*order)
    pick = F.max_by if forward else F.min_by
    edges = local.groupBy(*keys, "piece").agg(
        *[
            pick(f"in_{n}", F.when(F.col(f"in_{n}").isNotNull(), rank)).alias(f"edge_{n}")
            for n in values
        ]
    )
    # one row per piece a key reaches into; a key within one piece has nothing to carry
    across = Window.partitionBy(*keys).orderBy(F.col("piece") if forward else F.col("piece").desc())
    beyond = edges.select(
        *keys,
        "piece",
        *[
            F.last(f"edge_{n}", ignorenulls=True)
            .over(across.rowsBetween(Window.unboundedPreceding, -1))
            .alias(f"beyond_{n}")
            for n in values
        ],
    )
    crossing = F.lit(False)
    for n in values:
        crossing = crossing | F.col(f"beyond_{n}").isNotNull()
    found = beyond.filter(crossing).withColumnsRenamed({c: f"beyond_{c}" for c in [*keys, "piece"]})
    same = F.col("piece") == F.col("beyond_piece")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"beyond_{key}"))
    joined = local.join(found, same, "left")
    return joined.select(*df.columns, *[F.coalesce(f"local_{n}", f"beyond_{n}").alias(n) for n in values])


def next_value(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, area: StagingArea | None = None
) -> DataFrame:
    """``lead`` over a key of any size; ``value`` must not be null."""
    return carry(df, keys, order, {name: value}, forward=False, area=area)
