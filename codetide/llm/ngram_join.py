"""Jaccard join of documents on word n-grams, by vertical partitioning of the global n-gram order.

A document's n-grams are hashed to 64 bits.  The global order puts the most frequent n-grams last (those
in at least ``FREQUENT`` documents, at most ``MOST_FREQUENT`` of them, counted over all documents) and
orders the rest by hash.  Any order gives right results; this one keeps passages that many
documents share out of the prefixes.  The order is cut into ``FRAGMENTS`` pieces; a document's set falls
into one segment per fragment.  For a candidate pair each fragment counts its partial overlap by
itself, and the sums over fragments decide exactly.

Candidates: sets of similarity 0.8 share an n-gram within their first ``size - ceil(0.8 size) + 1``, and
so many of them, so early, that what follows can make up the rest.  Equal sets are one class and are
compared once.  Candidates are not verified pair by pair: they make groups, and what is in one group is
compared there.  First every class is taken with the leading classes of its n-grams: the one whose
n-grams most classes have, and others drawn by hash.  Only pairs from different groups are candidates
after that, so groups of near copies are not multiplied out, linked or not.  Every pair that can link
lies in one group then.

A group's classes are put in order of size and cut into blocks, and every two blocks whose sizes allow a
link are compared, each pair of them and each fragment in a task group of its own.  Partial overlaps of
all their classes come from products of 0/1 matrices, whose sum over the fragments tells the links: how
many each class has, and the components.  No pair is a row and no group is held whole.  Segments
are copied once per block they meet, so that a group of k classes costs up to k * k / 2
comparisons, as its links may be so many.

Work is spread by n-gram, by class and by fragment.  N-grams of ordinary frequency are grouped by a
window, whose groups the frequency bounds; frequent ones are aggregated and joined, where run-time
skew handling may split them.  Sets of 64-bit hashes stand for the texts: two different n-grams or sets
agree by chance once in 2**64.

Defined results: ``n_links`` is the number of other rows of similarity 0.8 or more, those of equal sets
among them.  A document without words or text has an empty set and links with nothing; its
component is its own id.  Repeated rows are documents like others.  A null id never names a component
that has another.  Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from codetide.llm.common import bounded, numbered, with_offset
from codetide.llm.components import components
from codetide.session import StagingArea, stage

WORDS = 5
FREQUENT = 16
MOST_FREQUENT = 500_000
TURNS = 3  # leading classes of an n-gram
BATCH = 128  # texts hashed together
BLOCK_CLASSES = 256  # classes compared with others as one block,
BLOCK_GRAMS = 2_000_000  # and their n-grams together
DENSE = 16  # an n-gram in so many sets of two blocks is counted by a dense product
DENSE_CELLS = 1 << 22
FRAGMENT_BITS = 3
FRAGMENTS = (1 << FRAGMENT_BITS) + 1  # one more for the frequent n-grams
STEP = np.uint64(0xD1342543DE82EF95)
SPREAD = np.uint64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * SPREAD
    values = (values ^ (values >> np.uint64(32))) * SPREAD
    return values ^ (values >> np.uint64(32))


def ngrams(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its n-grams; all words as one if there are fewer."""
    bodies = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    ends_of = np.cumsum([len(b) + 1 for b in bodies])
    solid = ~_SPACE[data]
    edge = np.diff(solid.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return [np.empty(0, np.uint64)] * len(texts)
    sizes = np.flatnonzero(edge == -1) - starts
    begins = np.cumsum(sizes) - sizes
    power = np.multiply.accumulate(np.full(int(sizes.max()), STEP))
    place = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    weighed = (_LOWER[data[solid]].astype(np.uint64) + np.uint64(1)) * power[place]
    hashed = _mix(np.add.reduceat(weighed, begins) + sizes.astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, ends_of), prepend=0)

    def rolled(part: np.ndarray, size: int) -> np.ndarray:
        n = len(part) - size + 1
        rolling = np.full(n, np.uint64(size))
        for k in range(size):
            rolling = rolling * STEP + part[k : k + n]
        return _mix(rolling)

    # one pass over all words; what reaches over the end of a text is left out below
    whole = rolled(hashed, words) if len(hashed) >= words else np.empty(0, np.uint64)
    found, at = [], 0
    for n in counts.tolist():
        if n >= words:
            found.append(np.unique(whole[at : at + n - words + 1]))
        else:
            found.append(rolled(hashed[at : at + n], n) if n else np.empty(0, np.uint64))
        at += n
    return found


def class_of(grams: np.ndarray) -> int:
    """A 64-bit name for a set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_size(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def in_order(grams: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """The set in the global order, and how many of it are not frequent."""
    if not len(frequent):
        return grams, len(grams)
    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    late = frequent[at] == grams
    return np.concatenate((grams[~late], grams[late])), int((~late).sum())


def _per_batch(make: Callable[[list, list[np.ndarray]], dict]):
    """mapInPandas over (doc_id, text): ``make`` turns ids and n-grams of some rows into columns.

    A ``text_key`` beside them is passed on; ``make`` gives one row per row then.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            texts = batch["text"].tolist()
            for at in range(0, len(ids), BATCH):
                made = pd.DataFrame(make(ids[at : at + BATCH], ngrams(texts[at : at + BATCH])))
                if "text_key" in batch:
                    made["text_key"] = batch["text_key"].to_numpy()[at : at + BATCH]
                yield made

    return run


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)


def _early(ids: list, sets: list[np.ndarray]) -> dict:
    """Counts of what stands early enough by hash to come into a prefix."""
    found = _joined([g[: prefix_size(len(g)) * 13 // 10 + 2] for g in sets])
    gram, n = np.unique(found, return_counts=True)
    return {"gram": gram, "n": n}


def _sets(frequent: np.ndarray):
    """Rows (doc_id, n_shingles, class, late): late if frequent n-grams come into the prefix."""

    def make(ids: list, sets: list[np.ndarray]) -> dict:
        return {
            "doc_id": pd.array(ids, "Int64"),
            "n_shingles": [len(g) for g in sets],
            "class": pd.array([class_of(g) if len(g) else None for g in sets], "Int64"),
            "late": [len(g) > 0 and in_order(g, frequent)[1] < prefix_size(len(g)) for g in sets],
        }

    return make


def _prefixes(frequent: np.ndarray, late: bool):
    """Rows (gram, class, pos) of the prefixes: the frequent n-grams in them, or the others; pos from 0."""

    def make(ids: list, sets: list[np.ndarray]) -> dict:
        grams, names, places = [], [], []
        for own in sets:
            ordered, ordinary = in_order(own, frequent)
            size = prefix_size(len(own))
            first, end = (ordinary, size) if late else (0, min(size, ordinary))
            if len(own) and first < end:
                grams.append(ordered[first:end])
                names.append(np.full(end - first, class_of(own)))
                places.append(np.arange(first, end))
        return {"gram": _joined(grams), "class": _joined(names), "pos": _joined(places)}

    return make


def _segments(frequent: np.ndarray):
    """Rows (class, fragment, grams), one for every fragment."""
    bounds = np.arange(1, FRAGMENTS - 1, dtype=np.uint64) << np.uint64(64 - FRAGMENT_BITS)

    def make(ids: list, sets: list[np.ndarray]) -> dict:
        names, fragments, held = [], [], []
        for own in sets:
            if not len(own):
                continue
            name, (ordered, ordinary) = class_of(own), in_order(own, frequent)
            cuts = np.searchsorted(ordered[:ordinary], bounds)
            for k, part in enumerate(np.split(ordered, [*cuts, ordinary])):
                names.append(name)
                fragments.append(k)
                held.append(part.view(np.int64))
        return {"class": names, "fragment": fragments, "grams": held}

    return make


def frequent_ngrams(texts: DataFrame) -> np.ndarray:
    """The n-grams to put last, sorted; at most ``MOST_FREQUENT``."""
    early = texts.mapInPandas(_per_batch(_early), "gram long, n long")
    counted = early.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    found = counted.orderBy(F.col("n").desc(), "gram").limit(MOST_FREQUENT).select("gram").toPandas()
    return np.sort(found["gram"].to_numpy(np.int64).view(np.uint64))


def _chosen(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose doc_id is in ``ids`` (doc_id), a staged table."""
    keys = bounded(ids.withColumnRenamed("doc_id", "__id"))
    return texts.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def _postings(texts: DataFrame, sets: DataFrame, frequent: np.ndarray, area: StagingArea) -> DataFrame:
    """Rows (gram, class, pos) of prefix n-grams that two classes share."""
    rows = lambda some, late: some.mapInPandas(_per_batch(_prefixes(frequent, late)), "gram long, class long, pos int")
    inside = Window.partitionBy("gram")
    ordinary = (
        rows(texts, False).withColumns({"lo": F.min("class").over(inside), "hi": F.max("class").over(inside)})
        .filter("lo < hi").select("gram", "class", "pos").distinct()
    )
    of_frequent = stage(sets.filter("late").select("doc_id").distinct(), "late-ids", area)
    late = stage(rows(_chosen(texts, of_frequent), True).distinct(), "late", area)
    ends = late.groupBy("gram").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi").select("gram")
    return stage(ordinary.union(late.join(ends, "gram")), "postings", area)


# elements that sets of these sizes share if they link
NEEDED = "(4 * (n_a + n_b) + 8) div 9"
# what lies behind the prefixes can add no more than the larger set has there
REACH = f"m + (4 * greatest(n_a, n_b) + 4) div 5 - 1 >= {NEEDED}"
# nor what lies behind the last n-gram they share in the prefixes
BEHIND = f"m + least(n_a - last_a, n_b - last_b) - 1 >= {NEEDED}"
# what lies before one shared n-gram, itself and what lies behind it
AROUND = f"least(pos_a, pos_b) + least(n_a - pos_a, n_b - pos_b) >= {NEEDED}"
SIMILAR_SIZE = "5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)"


class _Table:
    """Rows added step by step: one folder, read as one scan."""

    def __init__(self, label: str, schema: str, area: StagingArea) -> None:
        self.path, self.schema, self.spark = area.path(label), schema, area.spark

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def _candidates(met: DataFrame) -> DataFrame:
    """Pairs (a, b) that can link, by their shared n-grams (a, b, n_a, n_b, pos_a, pos_b)."""
    counted = met.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("m"), F.max("pos_a").alias("last_a"), F.max("pos_b").alias("last_b"))
    return counted.filter(REACH).filter(BEHIND).select("a", "b")


def _centrality(postings: DataFrame) -> DataFrame:
    """Per class, how many classes have its prefix n-grams, on average: the text that others were made from leads."""
    spread = postings.groupBy("gram").agg(F.count("*").alias("df"))
    return postings.join(spread, "gram").groupBy("class").agg(F.avg("df").alias("common"))


def _stars(placed: DataFrame) -> DataFrame:
    """Candidate pairs of a class (b) and a leading class (a) of its n-grams; some shared n-grams may not be counted.

    An n-gram's leading classes are the most common one and those with the
    smallest hashes of class and turn.
    """
    ranks = [F.struct(-F.col("common"), F.col("class"))] + [F.struct(F.xxhash64("class", F.lit(t)), F.col("class")) for t in range(1, TURNS)]
    leads = placed.groupBy("gram").agg(*[F.min_by(F.struct("class", "n", "pos"), rank).alias(f"lead{t}") for t, rank in enumerate(ranks)])
    met = placed.join(leads, "gram").select("class", "n", "pos", F.explode(F.array_distinct(F.array(*[f"lead{t}" for t in range(TURNS)]))).alias("lead"))
    met = met.select(
        F.col("lead.class").alias("a"), F.col("lead.n").alias("n_a"), F.col("lead.pos").alias("pos_a"),
        F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"),
    )
    return _candidates(met.filter("a != b").filter(SIMILAR_SIZE).filter(AROUND))


def _across(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """All candidate pairs between ``groups`` (node, root)."""
    rooted = placed.join(groups.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed = rooted.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("gram")
    rooted = rooted.join(mixed, "gram")
    side = lambda s: rooted.select("gram", F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("root", "n", "pos")])
    return _candidates(side("a").join(side("b"), "gram").filter(f"a < b and root_a != root_b and {SIMILAR_SIZE} and {AROUND}"))


def overlaps(sets: list[np.ndarray], rows: int, own: bool) -> np.ndarray:
    """How many elements each of the first ``rows`` sets shares with each of the others, or of the same if ``own``."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(gram, kind="stable")  # by n-gram, then row
    row, gram = row[order], gram[order]
    wide = len(sets) if own else len(sets) - rows
    total = np.zeros((rows, wide), np.int64)

    few = held[gram] < DENSE
    some, of = row[few], gram[few]
    for apart in range(1, DENSE - 1):
        met = of[apart:] == of[:-apart]
        a, b = some[:-apart][met], some[apart:][met]
        if not own:
            across = (a < rows) & (b >= rows)
            a, b = a[across], b[across] - rows
        total += np.bincount(a * wide + b, minlength=total.size).reshape(total.shape)
    if own:
        total += total.T  # the diagonal is not looked at

    column = np.cumsum(held >= DENSE) - 1
    row, column = row[~few], column[gram[~few]]
    width = max(1, DENSE_CELLS // len(sets))
    for first in range(0, int((held >= DENSE).sum()), width):
        part = slice(*np.searchsorted(column, [first, first + width]))
        dense = np.zeros((len(sets), width), np.float32)  # exact: its sums stay below 2**24
        dense[row[part], column[part] - first] = 1
        total += (dense[:rows] @ (dense if own else dense[rows:]).T).astype(np.int64)
    return total


def _partial(group: pd.DataFrame) -> pd.DataFrame:
    """One fragment of two blocks, or of one with itself: the classes in order, and how much each two share there."""
    group = group.sort_values(["right", "class"], kind="stable")
    right = group["right"].to_numpy(bool)
    shared = overlaps([np.asarray(s, np.int64) for s in group["grams"]], int((~right).sum()), not right.any())
    at = group.iloc[0]
    # the classes are the same in every fragment, and told by the first
    told = {c: [group[c].to_numpy() if at["fragment"] == 0 else np.empty(0, np.int64)] for c in ("class", "n", "size")}
    return pd.DataFrame({"i": [at["i"]], "j": [at["j"]], "rows": [len(shared)], **told, "shared": [shared.astype("<i4").tobytes()]})


def _block_links(group: pd.DataFrame) -> pd.DataFrame:
    """Rows (class, linked, near): the documents in linked classes of the other block, and a class it is connected to."""
    told = group[group["class"].map(len) > 0].iloc[0]
    names, n, size = (np.asarray(told[c], np.int64) for c in ("class", "n", "size"))
    rows, own = int(told["rows"]), told["i"] == told["j"]
    total = sum(np.frombuffer(s, "<i4").astype(np.int64) for s in group["shared"]).reshape(rows, -1)
    others = slice(0, rows) if own else slice(rows, None)
    linked = np.zeros((len(names), len(names)), bool)
    linked[:rows, others] = 180 * total >= 80 * (n[:rows, None] + n[None, others])
    linked |= linked.T
    np.fill_diagonal(linked, False)
    near, before = np.arange(len(names)), None
    while before is None or (near != before).any():
        before = near
        near = np.minimum(near, np.where(linked, near[None, :], len(names)).min(axis=1))
    return pd.DataFrame({"class": names, "linked": linked @ size, "near": names[near]})


def _compared(texts: DataFrame, grouped: DataFrame, frequent: np.ndarray, area: StagingArea) -> DataFrame:
    """Staged rows (class, linked, near) of the classes of ``grouped`` (class, root, rep, n, size) with others in their group.

    A class comes once per block it met: with the number of documents it links with there, and the
    first class there that it is connected to.
    """
    several = grouped.groupBy("root").agg(F.count("*").alias("k")).filter("k > 1").select("root")
    inside = grouped.join(several, "root")
    placed = numbered(inside.withColumn("weight", F.greatest("n", F.lit(BLOCK_GRAMS // BLOCK_CLASSES))), ["root", "n", "class"], area)
    before = Window.partitionBy("piece").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    weighed = placed.withColumn("__inside", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    weighed = with_offset(weighed, {"__before": F.sum("weight")})
    blocked = weighed.withColumn("block", F.expr(f"(__before + __inside) div {BLOCK_GRAMS}"))
    blocked = stage(blocked.select("class", "root", "rep", "n", "size", "block"), "blocked", area)

    # blocks of one group; several small ones may share a block and are compared there in one go
    spans = blocked.groupBy("root", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    side = lambda s: spans.select("root", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "lo", "hi")])
    met = side("a").join(side("b"), "root").filter("block_a < block_b and 5 * hi_a >= 4 * lo_b")
    met = stage(met.select("root", F.col("block_a").alias("i"), F.col("block_b").alias("j")), "block-pairs", area)
    turns = (
        spans.select("root", "block", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(False).alias("right"))
        .union(met.select("root", F.col("i").alias("block"), "i", "j", F.lit(False)))
        .union(met.select("root", F.col("j").alias("block"), "i", "j", F.lit(True)))
    )
    turns = bounded(stage(turns, "turns", area))

    wanted = stage(blocked.select(F.col("rep").alias("doc_id")).distinct(), "block-ids", area)
    segments = _chosen(texts, wanted).mapInPandas(_per_batch(_segments(frequent)), "class long, fragment int, grams array<long>")
    # rows of one id may have other texts, and rows of one text come once each
    segments = segments.join(blocked.select("class", "root", "block", "n", "size"), "class").dropDuplicates(["class", "fragment"])
    rows = segments.join(turns, ["root", "block"]).select("i", "j", "right", "fragment", "class", "n", "size", "grams")
    told = "i long, j long, rows int, class array<long>, n array<long>, size array<long>, shared binary"
    partial = rows.groupBy("i", "j", "fragment").applyInPandas(_partial, told)
    return stage(partial.groupBy("i", "j").applyInPandas(_block_links, "class long, linked long, near long"), "compared", area)


def text_key() -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64("text")


def join(docs: DataFrame, area: StagingArea, count_links: bool = True, keep_text_key: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, n_links if ``count_links``, ``text_key`` if asked for."""
    texts = docs.select("doc_id", "text")
    frequent = frequent_ngrams(texts)
    columns, rows = "doc_id long, n_shingles long, class long, late boolean", texts
    if keep_text_key:
        columns, rows = f"{columns}, text_key long", texts.withColumn("text_key", text_key())
    sets = stage(rows.mapInPandas(_per_batch(_sets(frequent)), columns), "sets", area)
    by_class = sets.filter("class is not null").groupBy("class")
    classes = stage(
        by_class.agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.count("*").alias("size")), "classes", area
    )
    postings = _postings(texts, sets, frequent, area)
    sized = classes.select("class", "n").join(_centrality(postings), "class")
    placed = stage(postings.join(sized, "class"), "placed", area)

    pairs = _Table("candidates", "a long, b long", area)
    pairs.add(_stars(placed))
    groups, held = components(pairs.read())
    pairs.add(_across(placed, groups))
    held.release()
    groups, held = components(pairs.read())
    grouped = classes.join(groups.withColumnRenamed("node", "class"), "class").select("class", "root", "rep", "n", "size")
    compared = _compared(texts, grouped, frequent, area)
    held.release()

    roots, held = components(compared.select(F.col("class").alias("a"), F.col("near").alias("b")))
    named = stage(
        classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "rep", "size", F.coalesce("root", "class").alias("root")), "roots", area
    )
    held.release()
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = named.join(smallest, "root").select("class", "size", "component_id")
    kept = ["text_key"] if keep_text_key else []
    empty = sets.filter("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *kept)
    if count_links:
        linked = compared.groupBy("class").agg(F.sum("linked").alias("linked"))
        found = found.join(linked, "class", "left").withColumn("n_links", F.col("size") - 1 + F.coalesce("linked", F.lit(0)))
        empty = empty.withColumn("n_links", F.lit(0).cast("long"))
    found = stage(found.drop("size", "linked"), "components", area)
    full = sets.filter("class is not null").join(found, "class").select(empty.columns)
    return full.union(empty)
