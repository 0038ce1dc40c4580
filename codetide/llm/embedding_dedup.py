"""Near-duplicate vectors by lattice hashing, verified by cosine.

Equal vectors are one class, named by a number of its own, since one id may have several vectors.  Each class is projected at
random to eight dimensions, once per table, and decoded to the nearest point of the E8 lattice, its
own cell.  It also asks in the ``PROBES`` neighbouring cells that lie closest to it.  Two classes that
meet in a cell of one of them are compared.  ``tests/llm`` measures the recall against brute force.

A row that travels to a cell carries its vector as bytes, with the length of what rounding lost.  The
bound that gives on the cosine settles nearly all pairs one way or the other; only pairs within the
bound of the threshold fetch their vectors and are compared in double precision, so no pair is
reported that is not one.  A cell with more than ``CELL_BLOCK`` own classes is cut into blocks of
them, and every row goes to all blocks: a hot cell is spread over as many tasks as it has blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite parts link with
nothing, nor do rows without an id; their component is their own id.  Vectors of different length
never link.  Repeated rows are vectors like others.  Columns beside vec_id and embedding are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from codetide.llm.components import components
from codetide.llm.lattice import Tables
from codetide.session import StagingArea, stage

COSINE = 0.9
TABLES = 8
PROBES = 8
SPACING = 0.42
CELL_BLOCK = 4096
CHUNK = 2048

ENTRY = "cell long, home boolean, turn int, rep long, dim int, scale float, lost float, low binary, homes binary"


def usable(vector: str) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; the largest part is taken out first."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _entries(tables: int, probes: int, spacing: float, slim: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Tables] = {}
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            parts = batch.column("vector")
            sizes = np.diff(parts.offsets.to_numpy())
            flat = parts.flatten().to_numpy()
            begins = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                of = np.flatnonzero(sizes == dim)
                for at in range(0, len(of), 512):
                    some = of[at : at + 512]
                    units = unit(flat[begins[some][:, None] + np.arange(dim)])
                    hashing = made.setdefault(int(dim), Tables(int(dim), tables, spacing))
                    yield _rows(reps[some], units, *hashing.cells(units, probes), slim)

    return run


def _rows(reps, units, own, near, slim) -> pa.RecordBatch:
    """One row per cell a class lies in or asks in."""
    n, tables, probes = near.shape
    cells = np.concatenate((own[:, :, None], near), axis=2)
    each = tables * (probes + 1)
    home = np.zeros((n, tables, probes + 1), bool)
    home[:, :, 0] = True
    columns = {"cell": cells.ravel(), "home": home.ravel()}
    if not slim:
        scale = np.abs(units).max(axis=1, keepdims=True) / 127
        low = np.rint(units / scale)
        lost = np.sqrt(((units - low * scale) ** 2).sum(axis=1)) * 1.0001 + 1e-6
        turn = np.broadcast_to(np.arange(tables)[None, :, None], home.shape)
        repeat = lambda values: pa.array(values).take(pa.array(np.repeat(np.arange(n), each)))
        columns |= {
            "turn": turn.ravel().astype(np.int32),
            "rep": np.repeat(reps, each),
            "dim": np.full(n * each, units.shape[1], np.int32),
            "scale": np.repeat(scale.ravel().astype(np.float32), each),
            "lost": np.repeat(lost.astype(np.float32), each),
            "low": repeat([r.tobytes() for r in low.astype(np.int8)]),
            "homes": repeat([r.tobytes() for r in own.astype(np.int32)]),
        }
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


class _Cell:
    """Own classes of the cell at hand, compared with all that come to it."""

    def __init__(self, key: tuple) -> None:
        self.key = key
        self.own: tuple[np.ndarray, ...] | None = None

    def meet(self, rows: tuple[np.ndarray, ...], n_own: int, turn: int, threshold: float) -> list[tuple[np.ndarray, ...]]:
        """Pairs of ``rows`` with own classes; the first ``n_own`` rows are own and join them.

        Two own classes are compared when the later of them comes.  Pairs that met in an earlier
        table's cell are left to that.
        """
        earlier = 0 if self.own is None else len(self.own[0])
        if n_own:
            new = tuple(x[:n_own] for x in rows)
            self.own = new if self.own is None else tuple(map(np.concatenate, zip(self.own, new)))
        found = []
        if self.own is None:
            return found
        rep, lost, vectors, homes = self.own
        place = np.where(np.arange(len(rows[0])) < n_own, earlier + np.arange(len(rows[0])), len(rep))
        for at in range(0, len(rep), CHUNK):
            part = slice(at, at + CHUNK)
            dots = rows[2] @ vectors[part].T
            doubt = (rows[1][:, None] + lost[part][None, :]) * 1.01
            i, j = np.nonzero(dots + doubt >= threshold)
            keep = (j + at < place[i]) & (rows[0][i] != rep[j + at])
            if turn:
                keep &= ~(rows[3][i, :turn] == homes[j + at, :turn]).any(axis=1)
            i, j = i[keep], j[keep]
            found.append((rows[0][i], rep[j + at], dots[i, j] - doubt[i, j] >= threshold))
        return found


def _meet(threshold: float):
    """Pairs of classes that meet in a cell; rows come sorted by cell, own classes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = _Cell(())
        for batch in batches:
            if not batch.num_rows:
                continue
            number = lambda k: batch.column(k).to_numpy(zero_copy_only=False)
            keys = np.stack([number("cell"), number("block"), number("dim")])
            begins = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            ends = np.append(begins[1:], batch.num_rows)
            home, turns, reps = number("home"), number("turn"), number("rep")
            lost, scale = number("lost").astype(np.float64), number("scale")
            low, homes = batch.column("low"), batch.column("homes")
            out = []
            for lo, hi, n_own in zip(begins.tolist(), ends.tolist(), np.add.reduceat(home.astype(np.int64), begins).tolist()):
                key = tuple(keys[:, lo])
                if key != cell.key:
                    cell = _Cell(key)
                if not n_own and cell.own is None:
                    continue  # nobody lives here
                if hi - lo == 1 and cell.own is None and hi < batch.num_rows:
                    continue  # and here nobody came
                bytes_of = lambda column, kind: np.frombuffer(b"".join(column.slice(lo, hi - lo).to_pylist()), kind).reshape(hi - lo, -1)  # noqa: B023, E731
                rows = (reps[lo:hi], lost[lo:hi], bytes_of(low, np.int8).astype(np.float32) * scale[lo:hi, None], bytes_of(homes, np.int32))
                out += cell.meet(rows, n_own, int(turns[lo]), threshold)
            if out:
                a, b, sure = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b), "sure": sure})

    return run


def _dealt(entries: DataFrame, crowds: DataFrame) -> DataFrame:
    """Entries with the block of their cell; rows of a crowded cell go to a grid of blocks.

    Own classes are dealt into ``k`` lists and all rows into ``s`` slices.  A block holds one list, with
    its classes as own, and the rows of one slice.
    """
    crowded = crowds.select(
        F.col("cell").alias("__cell"),
        F.ceil(F.col("n_own") / CELL_BLOCK).cast("int").alias("k"),
        F.ceil(F.col("n") / (16 * CELL_BLOCK)).cast("int").alias("s"),
    )
    joined = entries.join(crowded, F.col("cell") == F.col("__cell"), "left")
    mine = F.pmod(F.xxhash64("rep"), F.col("k")).cast("int")
    turn = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("s")).cast("int")
    to = lambda block, home: F.struct(block.cast("int").alias("block"), F.lit(home).alias("home"))
    lists = F.sequence(F.lit(0), F.col("k") - 1)
    as_own = F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda x: to(mine * F.col("s") + x, True))
    asking = F.transform(F.filter(lists, lambda b: ~F.col("home") | (b != mine)), lambda b: to(b * F.col("s") + turn, False))
    plain = F.array(F.struct(F.lit(0).alias("block"), F.col("home")))
    target = F.when(F.col("k").isNull(), plain).when(F.col("home"), F.concat(as_own, asking)).otherwise(asking)
    return joined.withColumn("to", F.explode(target)).select(
        "cell", "to.block", "to.home", *[c.split()[0] for c in ENTRY.split(", ") if c.split()[0] not in ("cell", "home")]
    )


def links(classes: DataFrame, area: StagingArea, threshold: float = COSINE) -> DataFrame:
    """Pairs (a, b), a < b, of ``classes`` (rep, vector) with a cosine of at least ``threshold``."""
    entries = lambda slim: classes.select("rep", "vector").mapInArrow(
        _entries(TABLES, PROBES, SPACING, slim), "cell long, home boolean" if slim else ENTRY
    )
    counts = entries(True).groupBy("cell").agg(F.count_if("home").alias("n_own"), F.count("*").alias("n"))
    crowds = counts.filter((F.col("n_own") > 0) & ((F.col("n_own") > CELL_BLOCK) | (F.col("n") > 16 * CELL_BLOCK)))
    dealt = _dealt(entries(False), stage(crowds, "crowds", area)).repartition("cell", "block")
    sorted_rows = dealt.sortWithinPartitions("cell", "block", "dim", F.col("home").desc(), "rep")
    met = sorted_rows.mapInArrow(_meet(threshold), "a long, b long, sure boolean")
    pairs = stage(met.groupBy("a", "b").agg(F.max("sure").alias("sure")), "pairs", area)

    @F.pandas_udf("double")
    def cosine(left, right):
        import pandas as pd

        return pd.Series([float(unit(np.stack([a]))[0] @ unit(np.stack([b]))[0]) for a, b in zip(left, right)])

    side = lambda name: classes.select(F.col("rep").alias(name), F.col("vector").alias(f"vector_{name}"))
    doubtful = pairs.filter("not sure").select("a", "b").join(side("a"), "a").join(side("b"), "b")
    checked = doubtful.filter(cosine("vector_a", "vector_b") >= threshold).select("a", "b")
    return pairs.filter("sure").select("a", "b").union(checked)


def deduplicate(embeddings: DataFrame, area: StagingArea) -> DataFrame:
    """Per row of ``embeddings``: vec_id, n_links, component_id, kept."""
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    good = F.col("vec_id").isNotNull() & usable("vector")
    sound = rows.filter(good)
    by_vector = sound.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = stage(by_vector.withColumn("rep", F.monotonically_increasing_id()), "classes", area)
    pairs = stage(links(classes, area), "links", area)

    sides = pairs.union(pairs.select("b", "a")).toDF("node", "other")
    sizes = classes.select(F.col("rep").alias("other"), "n")
    linked = sides.join(sizes, "other").groupBy("node").agg(F.sum("n").alias("others"))
    roots, held = components(pairs)
    roots = stage(roots, "roots", area)
    held.release()
    # the smallest id of each component that has links
    inside = classes.select(F.col("rep").alias("node"), "first").join(roots, "node")
    smallest = inside.groupBy("root").agg(F.min("first").alias("smallest"))
    placed = roots.join(smallest, "root").select("node", "smallest")
    facts = (
        classes.join(linked, F.col("rep") == linked["node"], "left").drop("node")
        .join(placed, F.col("rep") == placed["node"], "left").drop("node")
        .select("vector", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("smallest", "first").alias("component_id"))
    )
    found = sound.join(facts, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
