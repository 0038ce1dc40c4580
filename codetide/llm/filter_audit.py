"""How filters of a corpus interact: what each removes in every order of applying them.

Four filters look at one text; the fifth asks for an equal text under a smaller id.  For that one,
a counting Bloom sketch of all texts clears most rows before any text is moved: tasks count their
texts' cells, up to "several", in blocks of a sketch sized by the number of rows; blocks are added
up; a row with a cell that was counted once stands alone for certain.  Only texts of the other rows are shuffled, grouped
by the full text with their smallest id.  Flags then meet by the texts' digests, and each row
becomes one mask of failed filters.  Everything after that is addition over masks: a filter of an order removes the masks
that hold it and none of the filters before it.

Defined results: a null text is empty: it fails A alone, and E if an earlier text is empty.  Very long texts are taken whole.  Rows with the
same text and the same id do not fail E by each other; a row without an id neither fails E nor makes others fail.
Repeated rows count each.  A null lang counts as the empty one.  An id with several labels has a mark if one of them
has it; labels without an id mark nothing.  An empty table gives an empty result.  Columns
beside doc_id, text and lang, and doc_id, quality and toxic, are not looked at.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from codetide.llm.common import bounded
from codetide.session import StagingArea, stage

FILTERS = "ABCDE"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
# cells a row has in the sketch, cells it is counted in, cells of a block (a power of two)
CELLS_PER_ROW = 16
PROBES = 3
CELLS = 512
SEVERAL = 2
# blocks of a task before they are sent on; blocks that may go to every task, 64 bytes each
BLOCKS_IN_HAND = 1 << 16
BROADCAST_BLOCKS = 1 << 18


def failures(text: str) -> int:
    """The filters A to D that a text fails, as bits from the lowest."""
    data = text.encode()
    words = data.split()  # bytes split at the six ASCII blanks, no others
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, CAPITALS))) > 3 * len(text)) << 2
        | (len(data.translate(None, MARKS)) < len(data)) << 3
    )


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks = np.fromiter(map(failures, batch.column("text").to_pylist()), np.int32, len(batch))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(masks), batch.column("digest")],
            ["doc_id", "part", "mask", "digest"],
        )


def _cells(digest: str = "digest") -> list[Column]:
    """Where a text is counted inside its block."""
    bits = F.xxhash64(digest, F.lit(1))
    width = CELLS.bit_length() - 1
    return [F.shiftright(bits, n * width).bitwiseAND(CELLS - 1).cast("int") for n in range(PROBES)]


def _block(blocks: int, digest: str = "digest") -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows by block, two bits a cell."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        block = batch.column("block").to_numpy()
        cells = np.stack([batch.column(f"cell{n}").to_numpy() for n in range(PROBES)], axis=1)
        order = np.argsort(block, kind="stable")
        begins = np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1])) if len(block) else []
        for a, b in zip(begins, np.append(begins[1:], len(order)) if len(block) else []):
            # a text that falls on one cell twice is counted there once
            rows = np.sort(cells[order[a:b]], axis=1)
            once = np.append(np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1], axis=1)
            counts = np.minimum(np.bincount(rows[once], minlength=CELLS), SEVERAL).astype(np.uint8)
            number = int(block[order[a]])
            held[number] = np.minimum(held[number] + counts, SEVERAL) if number in held else counts
        if len(held) >= BLOCKS_IN_HAND:
            yield _blocks(held)
            held = {}
    if held:
        yield _blocks(held)


def _blocks(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    packed = [(c[0::4] | c[1::4] << 2 | c[2::4] << 4 | c[3::4] << 6).tobytes() for c in held.values()]
    return pa.RecordBatch.from_pydict({"block": pa.array(list(held), pa.int64()), "counts": pa.array(packed, pa.binary())})


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of the whole table: a bit for each cell counted several times.  It has at most a few rows per task."""
    total = np.zeros(CELLS, np.uint8)
    for counts in rows["counts"]:
        packed = np.frombuffer(counts, np.uint8)
        total = np.minimum(total + np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel(), SEVERAL)
    bits = np.packbits(total == SEVERAL, bitorder="little").view(np.int64)
    return pd.DataFrame({"block": rows["block"].iloc[:1], "several": [bits]})


def _possible(facts: DataFrame, area: StagingArea) -> DataFrame:
    """Digests of texts that the sketch cannot tell from repeats."""
    blocks = facts.count() * CELLS_PER_ROW // CELLS + 1
    probes = facts.select(_block(blocks).alias("block"), *[c.alias(f"cell{n}") for n, c in enumerate(_cells())], "digest")
    counted = probes.drop("digest").mapInArrow(_count, "block long, counts binary")
    sketch = stage(counted.groupBy("block").applyInPandas(_merge, "block long, several array<long>"), "sketch", area)
    sketch = F.broadcast(sketch) if blocks <= BROADCAST_BLOCKS else sketch.hint("merge")
    unsure = F.lit(True)
    for n in range(PROBES):
        cell = F.col(f"cell{n}")
        unsure &= F.getbit(F.get("several", F.shiftright(cell, 6)), cell.bitwiseAND(63)) == 1
    return stage(probes.join(sketch, "block").filter(unsure).select("digest").distinct(), "possible", area)


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def masks(docs: DataFrame, area: StagingArea) -> DataFrame:
    """Rows of ``docs(doc_id, text, lang)`` as doc_id, part and mask, the bits of the filters that the row fails."""
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    facts = stage(
        texts.withColumn("digest", _digest()).mapInArrow(_facts, "doc_id long, part string, mask int, digest binary"), "facts", area
    )
    wanted = bounded(_possible(facts, area))
    repeats = texts.select("doc_id", "text", _digest().alias("digest")).join(wanted, "digest", "left_semi")
    smallest = repeats.groupBy("text").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    smallest = stage(smallest.filter("first < last").select(_digest().alias("digest"), "first"), "smallest", area)
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    mask = F.col("mask") + later * (1 << FILTERS.index("E"))
    return facts.join(bounded(smallest), "digest", "left").select("doc_id", "part", mask.alias("mask"))


def _steps() -> str:
    rows = []
    for order in itertools.permutations(FILTERS):
        for step, name in enumerate(order, 1):
            before = sum(1 << FILTERS.index(f) for f in order[: step - 1])
            rows.append({"filter_order": "".join(order), "step": step, "own": 1 << FILTERS.index(name), "before": before})
    return json.dumps(rows)


def audit(docs: DataFrame, labels: DataFrame, area: StagingArea) -> DataFrame:
    """Per part, order of filters and step: what is kept, removed, redundant, failed alone and lost, and the filter's total over all orders."""
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    marked = masks(docs, area).join(bounded(stage(marks, "marks", area)), "doc_id", "left")
    # at most 32 rows per part from here on
    counted = marked.groupBy("part", "mask").agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order:string,step:int,own:int,before:int>>")
    each = stage(counted, "masks", area).select("*", F.explode(steps).alias("at")).select("*", "at.*")
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda condition, count="rows": F.sum(F.when(condition, F.col(count)).otherwise(0)).cast("long")
    found = each.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    # 120 rows per part and filter
    return found.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
