"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph cells.

A text is cut into paragraphs (lines), and those into pieces that end at words whose hash is a
multiple of ``PIECE_WORDS``: cut points depend on the words around them only, so an edit changes the
pieces it touches and no others.  Each piece has a 64-bit digest that also counts its repeats.  A
sketch adds every digest to three cells (count, sum of digests, sum of check values).  Two sketches of
one size subtract cell by cell; what both texts share cancels, and peeling cells that hold a single
digest recovers the digests in which the texts differ.  If something is left over, the sketches
were too small and larger ones, with other cells, are tried.  Likeness is then the Jaccard
similarity of the two sets of pieces, from the number of recovered digests and the set sizes.

Documents are dealt by ranges of id that are cut at given ids, and the first document of a range is
also given to the range before it.  So each task finds every next document in its own range, texts
are shuffled once, and only the two documents at hand are in memory.

Defined results: a null text is an empty one.  A text without words has no piece; two such texts have
likeness 1, one of them and any other 0.  Rows of equal id are ordered by text.  Null ids come first.
With one row, the next document is itself.  Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from codetide.llm.common import tasks

PIECE_WORDS = 8
CELLS = 24
HASHES = 3
GROWTH = 4
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
ROUNDS_PER_TRY = 60
BATCH = 128

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
RETURNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * SPREAD + np.uint64((salt * 0x2545F4914F6CDD1D) % (1 << 64))
    values = (values ^ (values >> np.uint64(29))) * STEP
    return values ^ (values >> np.uint64(32))


def digests(text: str) -> np.ndarray:
    """The distinct 64-bit digests of a text's pieces; a repeat counts as a piece of its own."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    solid = ~_SPACE[data]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    power = np.multiply.accumulate(np.full(int(sizes.max()), STEP))
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    weighed = (data[solid].astype(np.uint64) + np.uint64(1)) * power[place]
    words = _mix(np.add.reduceat(weighed, np.cumsum(sizes) - sizes))
    lines = np.cumsum(data == 10)
    last = words % np.uint64(PIECE_WORDS) == 0
    last[:-1] |= lines[starts[1:]] != lines[starts[:-1]]  # a line ends here
    first = np.flatnonzero(np.concatenate(([True], last[:-1])))
    sizes = np.diff(np.append(first, len(words)))
    power = np.multiply.accumulate(np.full(int(sizes.max()), STEP))
    place = np.arange(len(words)) - np.repeat(first, sizes)
    pieces = np.sort(_mix(np.add.reduceat(words * power[place], first)))
    fresh = np.concatenate(([True], pieces[1:] != pieces[:-1]))
    nth = np.arange(len(pieces)) - np.maximum.accumulate(np.where(fresh, np.arange(len(pieces)), 0))
    return np.unique(_mix(pieces, 1) + _mix(nth.astype(np.uint64), 2))


def places(keys: np.ndarray, cells: int, salt: int) -> np.ndarray:
    """For each key its ``HASHES`` cells, each in a third of its own."""
    third = np.uint64(cells // HASHES)
    return np.stack([_mix(keys, 3 + salt * HASHES + h) % third + np.uint64(h) * third for h in range(HASHES)]).astype(np.int64)


class Sketches:
    """Sketches of many texts side by side, all of ``cells`` cells: three arrays of numbers."""

    def __init__(self, n: int, cells: int, salt: int = 0) -> None:
        self.n, self.cells, self.salt = n, cells, salt
        self.count = np.zeros(n * cells, np.int64)
        self.keys = np.zeros(n * cells, np.uint64)
        self.checks = np.zeros(n * cells, np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        """Add keys to their owners' sketches, or take them away (sign -1)."""
        if not len(keys):
            return
        at = (places(keys, self.cells, self.salt) + owner * self.cells).ravel()
        signs = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        wrapped = signs.astype(np.uint64)  # -1 wraps to the additive inverse
        np.add.at(self.count, at, np.tile(signs, HASHES))
        np.add.at(self.keys, at, np.tile(keys * wrapped, HASHES))
        np.add.at(self.checks, at, np.tile(_mix(keys, 99) * wrapped, HASHES))

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.cells, self.salt)
        out.count, out.keys, out.checks = self.count - other.count, self.keys - other.keys, self.checks - other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Recovered (owner, key) and, per sketch, whether nothing is left."""
        owners, found = [], []
        for _ in range(ROUNDS_PER_TRY):
            single = np.flatnonzero(np.abs(self.count) == 1)
            keys = self.keys[single] * self.count[single].astype(np.uint64)
            pure = _mix(keys, 99) * self.count[single].astype(np.uint64) == self.checks[single]
            single, keys = single[pure], keys[pure]
            if not len(single):
                break
            owner, sign = single // self.cells, self.count[single]
            # a key may stand alone in several of its cells
            order = np.lexsort((keys, owner))
            again = (owner[order][1:] == owner[order][:-1]) & (keys[order][1:] == keys[order][:-1])
            once = order[np.concatenate(([True], ~again))]
            owner, keys, sign = owner[once], keys[once], sign[once]
            owners.append(owner)
            found.append(keys)
            self.add(owner, keys, -sign)
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        done = ~left.reshape(self.n, self.cells).any(axis=1)
        return np.concatenate(owners) if owners else np.empty(0, np.int64), np.concatenate(found) if found else np.empty(0, np.uint64), done

    def encoded(self, i: int, size: int) -> str:
        """One sketch as text: number of digests, then the cells."""
        cut = slice(i * self.cells, (i + 1) * self.cells)
        cells = np.zeros(self.cells, np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")]))
        cells["count"], cells["key"], cells["check"] = self.count[cut], self.keys[cut], self.checks[cut] & np.uint64(0xFFFFFFFF)
        return f"{size:x}." + base64.b64encode(cells.tobytes()).decode("ascii")


def _spread(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sets]
    return np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets) if sets else np.empty(0, np.uint64)


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """Per pair of digest sets, how many digests only one of them has, recovered by peeling.

    Pairs that a size cannot settle are tried again at ``GROWTH`` times the size.  Cells are drawn
    anew each time, so every pair is settled in the end.
    """
    out, todo, salt = np.zeros(len(left), np.int64), np.arange(len(left)), 0
    while len(todo):
        a = Sketches(len(todo), cells, salt)
        b = Sketches(len(todo), cells, salt)
        a.add(*_spread([left[i] for i in todo]))
        b.add(*_spread([right[i] for i in todo]))
        owner, _, done = a.minus(b).peel()
        got = np.bincount(owner, minlength=len(todo))
        out[todo[done]] = got[done]
        todo, salt, cells = todo[~done], salt + 1, cells * GROWTH
    return out


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of each pair of digest sets."""
    different = differences(left, right)
    both = np.array([len(a) + len(b) for a, b in zip(left, right)])
    return np.where(both > 0, (both - different) / np.maximum(both + different, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the next."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def compare(ids: list, texts: list[str]) -> pd.DataFrame:
    """Result rows of all documents but the last of a run of neighbours."""
    n = len(texts) - 1
    changed = [edited(texts[i], texts[i + 1]) for i in range(n)]
    own = [digests(t) for t in texts]
    new = [digests(t) for t in changed]
    plain, other = Sketches(n, CELLS), Sketches(n, CELLS)
    plain.add(*_spread(own[:n]))
    other.add(*_spread(new))
    return pd.DataFrame(
        {
            "doc_id": pd.array(ids[:n], "Int64"),
            "n_chars": [len(t) for t in texts[:n]],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [plain.encoded(i, len(own[i])) for i in range(n)],
            "edited_fingerprint": [other.encoded(i, len(new[i])) for i in range(n)],
            "near_edited": likeness(own[:n], new),
            "near_next": likeness(own[:n], own[1:]),
        }
    )


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a range in order, guests from the next range last: each with the row after it."""
    ids: list = []
    texts: list[str] = []
    closed = False
    for batch in batches:
        for doc, text, guest in zip(batch["doc_id"], batch["text"], batch["guest"]):
            if closed:
                continue
            ids.append(None if pd.isna(doc) else int(doc))
            texts.append(text or "")
            closed = bool(guest)  # only the first guest is the next document
            if len(texts) > BATCH or closed:
                if len(texts) > 1:
                    yield compare(ids, texts)
                ids, texts = ids[-1:], texts[-1:]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprints and likenesses."""
    spark = docs.sparkSession
    ranges = tasks(spark)
    quantiles = docs.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []
    bounds = sorted(set(quantiles))
    cuts = F.array(*[F.lit(b) for b in bounds]).cast("array<long>")
    # null ids are before all others, so before every bound
    ranged = docs.select("doc_id", "text", F.size(F.filter(cuts, lambda b: F.coalesce(b <= F.col("doc_id"), F.lit(False)))).alias("range"))
    # one row per range: its first document
    firsts = ranged.groupBy("range").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("nulls")).orderBy("range").collect()
    if not firsts:
        return spark.createDataFrame([], RETURNS)
    before = {r["range"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}  # the last range comes before the first
    for_range = F.create_map(*[F.lit(x) for k, v in before.items() for x in (k, v)])
    first_of = F.create_map(*[x for r in firsts for x in (F.lit(r["range"]), F.lit(None if r["nulls"] else r["first"]).cast("long"))])
    lead = F.col("doc_id").eqNullSafe(F.element_at(first_of, F.col("range")))
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.element_at(for_range, F.col("range")).alias("range"), F.lit(True).alias("guest"))
    copies = ranged.select("doc_id", "text", F.explode(F.when(lead, F.array(own, guest)).otherwise(F.array(own))).alias("to"))
    dealt = copies.select("doc_id", "text", "to.range", "to.guest").repartitionById(ranges, F.col("range"))
    ordered = dealt.sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return ordered.select("doc_id", "text", "guest").mapInPandas(_in_order, RETURNS)
