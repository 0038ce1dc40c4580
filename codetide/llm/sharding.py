"""Shards of near equal bytes, cut contiguously so that equal texts stay together.

Groups of equal texts are ordered by their smallest id.  The smallest capacity for which a greedy
walk needs no more than the wanted shards is found by binary search.  The walk needs, for a place in
the running sum of bytes, the last group end at or before it; the driver holds only a grid of such
ends (at most ``GRID`` cells) with the number of ends each cell hides.  A walk that counts hidden ends
as anywhere gives a lower bound, one that counts them as nowhere an upper bound; cells where the two
still differ are looked into by one more aggregation, until both bounds meet.  So the result is exact,
while each round is one pass over a narrow table and the driver's share does not grow.

All is DataFrame work.  A hot text is one group of any size, but its rows are dealt by range and its
sizes are summed on the map side, so no task holds it.

Defined results: a null text has size 8 and crc32 0, and null texts are one group; the empty text is
another.  Null ids come first.  Rows that are equal in all respects get neighbouring slots.  With fewer
groups than shards some shards stay empty.  Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window, functions as F

from codetide.llm.common import numbered, with_offset
from codetide.session import StagingArea, stage

OVERHEAD = 8
GRID_BITS = 14
GRID = 1 << GRID_BITS


class Ends:
    """Group ends in the running sum, as far as known, and how many each cell hides."""

    def __init__(self, groups: DataFrame, total: int) -> None:
        self.groups = groups
        self.total = total
        self.known = [0]
        self.hidden = [0]  # ends strictly between the previous known one and this
        self.shift = [0]
        self._look(max(0, total.bit_length() - GRID_BITS), None, None)

    def _look(self, shift: int, parent_shift: int | None, parents: list[int] | None) -> None:
        cell = lambda by: F.shiftright(F.col("end") - 1, by)
        rows = self.groups if parents is None else self.groups.filter(cell(parent_shift).isin(parents))
        found = rows.groupBy(cell(shift).alias("cell")).agg(F.max("end").alias("end"), F.count("*").alias("n"))
        entries = dict(zip(self.known, zip(self.hidden, self.shift)))
        for row in found.collect():  # at most GRID cells
            entries[row["end"]] = (row["n"] - 1, shift)
        self.known = sorted(entries)
        self.hidden = [entries[e][0] for e in self.known]
        self.shift = [entries[e][1] for e in self.known]

    def reach(self, place: int, hopeful: bool) -> int:
        """The last end at or before ``place``; hopeful: hidden ones may lie right there."""
        at = bisect_right(self.known, place) - 1
        if hopeful and at + 1 < len(self.known) and self.hidden[at + 1]:
            return place
        return self.known[at]

    def walk(self, capacity: int, shards: int, hopeful: bool) -> list[int] | None:
        """Ends of the shards a greedy walk fills, or None if they do not suffice."""
        ends, at = [], 0
        for _ in range(shards):
            if at >= self.total:
                break
            at = self.reach(at + capacity, hopeful)
            ends.append(at)
        return ends if at >= self.total else None

    def least(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, hopeful) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def refine(self, low: int, high: int, shards: int) -> None:
        """Look into the cells that decide between two capacities."""
        near, far, wanted = 0, 0, set()
        for _ in range(shards):
            near, far = self.reach(near + low, False), min(self.total, self.reach(far + high, True))
            for i in range(bisect_right(self.known, near), min(bisect_left(self.known, far) + 1, len(self.known))):
                if self.hidden[i]:
                    wanted.add(i)
        by_shift: dict[int, list[int]] = {}
        for i in wanted:
            by_shift.setdefault(self.shift[i], []).append((self.known[i] - 1) >> self.shift[i])
        for shift, cells in by_shift.items():
            finer = max(1, GRID_BITS - len(cells).bit_length())
            self._look(max(0, shift - finer), shift, cells)


def cut(groups: DataFrame, shards: int) -> list[int]:
    """Ends of all shards but the last, for ``groups`` of (end in the running sum, bytes)."""
    total, largest = groups.agg(F.max("end"), F.max("bytes")).first()
    if not total:
        return [0] * (shards - 1)
    ends = Ends(groups, total)
    floor = max(largest, -(-total // shards))
    while True:
        high = ends.least(floor, total, shards, hopeful=False)
        low = ends.least(floor, high, shards, hopeful=True)
        if low == high:
            break
        ends.refine(low, high, shards)
    return balanced(ends, high, shards)[:-1]


def balanced(ends: Ends, capacity: int, shards: int) -> list[int]:
    """Cuts within the capacity, each as near to an even share of what is left as it allows.

    ``latest`` is the earliest place from which the rest still fits, taken from the right; where
    the known ends cannot tell it, the greedy cuts stand.
    """
    latest = [ends.total]
    for _ in range(shards):
        latest.append(ends.known[bisect_left(ends.known, max(0, latest[-1] - capacity))])
    latest.reverse()
    if latest[0] > 0:
        greedy = ends.walk(capacity, shards, hopeful=False)
        return greedy + [ends.total] * (shards - len(greedy))
    cuts, at = [], 0
    for k in range(1, shards + 1):
        want = at + (ends.total - at) / (shards - k + 1)
        low = bisect_left(ends.known, max(at, latest[k]))
        high = bisect_right(ends.known, min(at + capacity, ends.total)) - 1
        best = bisect_left(ends.known, want, low, high)
        if best > low and want - ends.known[best - 1] <= ends.known[best] - want:
            best -= 1
        at = ends.known[best]
        cuts.append(at)
    return cuts


def shard(docs: DataFrame, shards: int, area: StagingArea) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    facts = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("same"),
    )
    facts = stage(facts, "facts", area)
    firsts = facts.groupBy("same").agg(F.min("doc_id").alias("first"))
    order = [F.col("first").asc_nulls_first(), "same", F.col("doc_id").asc_nulls_first()]
    placed = numbered(facts.join(firsts, "same"), order, area, "in-order")
    inside = Window.partitionBy("piece").orderBy("position")
    summed = with_offset(
        placed.withColumn("__end", F.sum("size").over(inside)), {"__before": F.sum("size")}
    ).withColumn("end", F.col("__before") + F.col("__end"))
    line = stage(summed.select("doc_id", "size", "text_crc32", "first", "same", "position", "end"), "line", area)
    groups = line.groupBy("first", "same").agg(F.max("end").alias("end"), F.sum("size").alias("bytes"))
    cuts = cut(stage(groups.select("end", "bytes"), "groups", area), shards)
    dealt = line.withColumn(
        "shard", F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("end")))
    )
    starts = dealt.groupBy("shard").agg(F.min("position").alias("__start"))  # a row per shard
    return dealt.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("__start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
