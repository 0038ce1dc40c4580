"""Batches of similar lengths: optimal bucket boundaries, then batches within a token budget.

A global histogram of lengths (one aggregation) goes to the driver with a bounded number of cells:
lengths up to 1,024 each have one, longer ones are rounded up to ten significant bits.  Dynamic
programming over the cells picks the boundaries with the least padding.  A document's bucket follows
from its length; its batch from its place in the bucket, which is a global position minus the
bucket's first, so no bucket is held by one task.

A length is the number of words (runs without white space) plus one end token.  A null or empty
text has length 1.  A document longer than the budget is a batch of its own, whole.  Repeated rows
are packed each.  Columns named like the results are replaced by them; others are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from codetide.llm.common import numbered
from codetide.session import StagingArea

EXACT_BITS = 10
BUCKETS = 16
TOKEN_BUDGET = 16384
WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ("bucket", "width", "batch", "slot", "padding")


def n_tokens(text: str = "text") -> Column:
    """Words of the text and one end token."""
    return (F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)) + 1).cast("long")


def cell(length: Column) -> Column:
    """The length, rounded up to ten significant bits."""
    spare = F.greatest(F.length(F.bin(length)) - EXACT_BITS, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), spare)
    return (F.ceil(length / step) * step).cast("long")


def boundaries(cells: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Indexes of the last cell of each bucket, for the least total padding.

    ``cost(i, j)`` of cells i..j-1 in one bucket is their count times the last length, less their
    lengths.  It obeys the quadrangle inequality, so the best split moves only forward with j and
    each layer is solved by halving.
    """
    n = len(cells)
    before = np.concatenate(([0], np.cumsum(counts)))
    length = np.concatenate(([0], np.cumsum(sums)))
    best = np.concatenate(([0], cells * before[1:] - length[1:])).astype(float)
    splits = []
    for _ in range(1, min(buckets, n)):
        new, split = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            cost = best[i] + cells[j - 1] * (before[j] - before[i]) - (length[j] - length[i])
            k = int(cost.argmin())
            new[j], split[j] = cost[k], i[k]
            todo += [(lo, j - 1, a, int(i[k])), (j + 1, hi, int(i[k]), b)]
        splits.append(split)
        best = new
    ends, j = [], n
    for split in reversed(splits):
        if j:
            ends.append(j - 1)
            j = int(split[j])
    if j:
        ends.append(j - 1)
    return ends[::-1]


@dataclass(frozen=True)
class Plan:
    """Per bucket: the length all its documents are padded to, and rows per batch."""

    widths: list[int]
    rows: list[int]


def plan(lengths: DataFrame, buckets: int, budget: int) -> Plan:
    """From ``lengths`` (n_tokens), one row per document."""
    histogram = (
        lengths.groupBy(cell(F.col("n_tokens")).alias("cell"))
        .agg(F.count("*").alias("n"), F.sum("n_tokens").alias("total"), F.max("n_tokens").alias("longest"))
        .toPandas()
        .sort_values("cell")
    )
    if histogram.empty:
        return Plan([], [])
    ends = boundaries(*(histogram[c].to_numpy() for c in ("longest", "n", "total")), buckets)
    widths = [int(histogram["longest"].iloc[e]) for e in ends]
    return Plan(widths, [max(1, budget // w) for w in widths])


def pack(docs: DataFrame, area: StagingArea, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """``docs`` with bucket, width, batch (numbered through all buckets), slot, padding.

    Lengths are those of the column n_tokens, as ``n_tokens()`` gives them.
    """
    measured = docs.drop(*[c for c in RESULTS if c in docs.columns])
    chosen = plan(measured.select("n_tokens"), buckets, budget)
    widths = F.array(*[F.lit(w).cast("long") for w in chosen.widths] or [F.lit(0).cast("long")])
    rows = F.array(*[F.lit(r).cast("long") for r in chosen.rows] or [F.lit(1).cast("long")])
    dealt = measured.withColumn("bucket", F.size(F.filter(widths, lambda w: w < F.col("n_tokens"))))
    order = ["bucket", F.col("doc_id").asc_nulls_first(), "n_tokens"]
    placed = numbered(dealt, order, area, "by-bucket", "__position", "__piece").drop("__piece")
    # a row per bucket
    sizes = sorted(tuple(r) for r in placed.groupBy("bucket").agg(F.min("__position"), F.count("*")).collect())
    first, batches, at = [0] * max(1, len(chosen.widths)), [0] * max(1, len(chosen.widths)), 0
    for bucket, start, n in sizes:
        first[bucket], batches[bucket] = start, at
        at += -(-n // chosen.rows[bucket])
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    index = F.col("__position") - F.get(longs(first), F.col("bucket"))
    per_batch = F.get(rows, F.col("bucket"))
    return placed.withColumns(
        {
            "width": F.get(widths, F.col("bucket")),
            "batch": F.get(longs(batches), F.col("bucket")) + F.floor(index / per_batch),
            "slot": index % per_batch,
            "padding": F.get(widths, F.col("bucket")) - F.col("n_tokens"),
        }
    ).drop("__position")
