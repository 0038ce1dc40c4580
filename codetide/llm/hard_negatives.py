"""Hard negatives of anchors, bounded along a spanning tree of the anchors.

Anchors go against all rows in blocks: up to ``ANCHORS`` of them at a time are in every task, as a
tree that joins each to a near one.  A task takes its rows in tiles.  At the root all scores are
worked out; at a child, a row's score lies within the distance of the two anchors times the row's length of what is known at the parent.
Only rows whose bounds reach into a window still open are scored again: for positives, from the fifth best row so far up;
for negatives, between the share of the positive's score and that score, and again from the fifth best so
far.  Each task gives its best rows per anchor and window; their best over all tasks are the result.

Scores are inner products of integers, exact; the bounds get slack for their rounding.

Defined results: rows with a null vec_id, label or vector, or with null parts take no part, nor do vectors whose squared
length exceeds 2^62, since their scores need not fit 64 bits.  Vectors of different length never meet.  Empty vectors have score 0 with
each other.  Rows are told apart as rows: a repeated row is another row, and an anchor for itself.  Equal scores
go by smaller vec_id.  An anchor without positives, or a positive without negatives in its window, gives no
row.  An empty table gives an empty result.  Columns beside those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from codetide.llm.common import numbered
from codetide.session import StagingArea, stage

# anchors in every task at a time; rows of a tile
ANCHORS = 2048
TILE = 1024
_FOUND = "anchor long, slot int, score long, vec_id long, row long"
_NONE = np.zeros(0, np.int64)


class Tree:
    """Anchors of one length in an order that puts every anchor behind its nearest earlier one."""

    def __init__(self, rows: np.ndarray, labels: list, vectors: np.ndarray) -> None:
        plain = vectors.astype(np.float64)
        lengths = np.sqrt((plain**2).sum(axis=1))
        order, parents, reach = [0], [-1], [0.0]
        near = self._apart(plain, lengths, 0)
        parent = np.zeros(len(rows), np.int64)
        near[0] = np.inf
        for _ in range(len(rows) - 1):
            nearest = int(np.argmin(near))
            parents.append(int(parent[nearest]))
            reach.append(float(near[nearest]))
            order.append(nearest)
            apart = self._apart(plain, lengths, nearest)
            closer = (apart < near) & np.isfinite(near)
            near[closer], parent[closer] = apart[closer], len(order) - 1
            near[nearest] = np.inf
        self.rows, self.vectors, self.lengths = rows[order], vectors[order], lengths[order]
        self.labels = [labels[n] for n in order]
        self.parents, self.reach = parents, reach

    @staticmethod
    def _apart(plain: np.ndarray, lengths: np.ndarray, one: int) -> np.ndarray:
        return np.sqrt(((plain - plain[one]) ** 2).sum(axis=1))


class Best:
    """The ``count`` best rows of a window: by score from above, then by vec_id."""

    def __init__(self, low: float, high: float, count: int) -> None:
        self.low, self.high, self.count = low, high, count
        self.score, self.vec_id, self.row = _NONE, _NONE, _NONE

    @property
    def least(self) -> float:
        """A row below this score is not wanted any more."""
        return max(self.low, self.score[-1]) if len(self.score) == self.count else self.low

    def take(self, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        inside = (score >= self.least) & (score <= self.high)
        if inside.any():
            joined = [np.concatenate((a, b[inside])) for a, b in ((self.score, score), (self.vec_id, vec_id), (self.row, row))]
            order = np.lexsort((joined[2], joined[1], -joined[0]))[: self.count]
            self.score, self.vec_id, self.row = (x[order] for x in joined)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, ids, labels and vectors of one length at a time."""
    for batch in batches:
        row, vec_id = batch.column("row").to_numpy(), batch.column("vec_id").to_numpy()
        label = batch.column("label").to_numpy(zero_copy_only=False)
        parts = batch.column("vector")
        offsets, flat = parts.offsets.to_numpy(), parts.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        for size in np.unique(sizes):
            of = np.flatnonzero(sizes == size)
            for at in range(0, len(of), TILE):
                some = of[at : at + TILE]
                yield row[some], vec_id[some], label[some], flat[offsets[some][:, None] + np.arange(size)]


def _scan(trees: dict[int, Tree], windows: dict[int, list[tuple[float, float]]], same: bool, count: int):
    """Best rows of a task for each window of each anchor, among rows of the same label or of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {row: [Best(low, high, count) for low, high in ranges] for row, ranges in windows.items()}
        for row, vec_id, label, vectors in _tiles(batches):
            tree = trees.get(vectors.shape[1])
            if tree is None:
                continue
            lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            low = np.empty((len(tree.rows), len(row)))
            high = np.empty_like(low)
            for n, anchor in enumerate(tree.rows.tolist()):
                if n == 0:
                    low[0] = high[0] = vectors @ tree.vectors[0]
                else:
                    slack = (tree.reach[n] * (1 + 1e-9) + 1e-12 * tree.lengths[n]) * lengths + 1e-3
                    np.subtract(low[tree.parents[n]], slack, out=low[n])
                    np.add(high[tree.parents[n]], slack, out=high[n])
                open_ = best.get(anchor, ())
                if not open_:
                    continue
                wanted = (high[n] >= min(b.least for b in open_)) & (low[n] <= max(b.high for b in open_))
                wanted &= (label == tree.labels[n]) == same
                if same:
                    wanted &= row != anchor
                some = np.flatnonzero(wanted)
                if len(some):
                    score = vectors[some] @ tree.vectors[n]
                    low[n, some] = high[n, some] = score
                    for b in open_:
                        b.take(score, vec_id[some], row[some])
        rows = [
            (anchor, slot, *values)
            for anchor, ranges in best.items()
            for slot, b in enumerate(ranges)
            for values in zip(b.score.tolist(), b.vec_id.tolist(), b.row.tolist())
        ]
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_pydict(
                {n: pa.array(c, pa.int32() if n == "slot" else pa.int64()) for n, c in zip(("anchor", "slot", "score", "vec_id", "row"), columns)}
            )

    return run


def _top(found: DataFrame, count: int) -> DataFrame:
    """The best ``count`` of what the tasks found for each window: a few rows per task and window."""
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= count)


def quantised(vector: str, scale: float = 256.0) -> Column:
    """Every part times ``scale``, rounded down; null for a vector with a null or non-finite part."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def usable(vector: str) -> Column:
    """Whether a vector of integers is whole and its scores fit 64 bits."""
    square = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return F.coalesce(square <= float(1 << 62), F.lit(False))


def mine(vectors: DataFrame, area: StagingArea, positives: int = 5, negatives: int = 5, share: int = 80) -> DataFrame:
    """Negatives of every row of ``vectors(vec_id, label, vector, anchor)`` whose ``anchor`` is true, per positive.

    ``vector`` holds integers (long).  A negative has at least ``share`` hundredths of the positive's score and at most all of it.
    """
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector")
    rows = vectors.select("vec_id", "label", "vector", "anchor").filter(whole)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors", area)
    asking = numbered(rows.filter("anchor").drop("anchor"), ["vec_id", "row"], area, "asking").drop("piece")
    asking = stage(asking, "anchors", area)
    number = asking.count()
    compared = rows.select("row", "vec_id", "label", "vector")
    liked, disliked = area.path("positives"), area.path("negatives")
    for at in range(0, number, ANCHORS):
        block = asking.filter(F.col("position").between(at, at + ANCHORS - 1)).collect()
        by_size: dict[int, list] = {}
        for r in block:
            by_size.setdefault(len(r["vector"]), []).append(r)
        trees = {
            size: Tree(np.array([r["row"] for r in some]), [r["label"] for r in some], np.array([r["vector"] for r in some], np.int64).reshape(len(some), size))
            for size, some in by_size.items()
        }
        open_ = {r["row"]: [(-np.inf, np.inf)] for r in block}
        found = compared.mapInArrow(_scan(trees, open_, True, positives), _FOUND)
        here = f"{liked}/block={at}"
        _top(found, positives).write.parquet(here)
        close: dict[int, list[tuple[float, float]]] = {r["row"]: [] for r in block}
        kept = compared.sparkSession.read.parquet(here).select("anchor", "rank", "score").orderBy("anchor", "rank").collect()
        for r in kept:
            # 80 * positive <= 100 * negative, in integers; a score below 0 leaves no room
            close[r["anchor"]].append((-(-share * r["score"] // 100), r["score"]))
        found = compared.mapInArrow(_scan(trees, close, False, negatives), _FOUND)
        _top(found, negatives).write.parquet(f"{disliked}/block={at}")
    spark = rows.sparkSession
    schema = f"{_FOUND}, rank int, block long"
    if not number:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    good = spark.read.schema(schema).parquet(liked).select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    bad = spark.read.schema(schema).parquet(disliked).select(
        "anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    names = asking.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return good.join(bad, ["anchor", "slot"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
