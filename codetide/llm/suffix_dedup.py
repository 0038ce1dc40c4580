"""Removal of passages that stand in an earlier document, by a collection's transform built column by column.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a document with a smaller id.
Suffixes are ordered only among strings that can share a window, so the collection is cut up first:

1. Every window of ``WINDOW`` bytes names the least hash of the ``ANCHOR``-byte strings in it, the first one
   if it comes twice: its anchor.  Windows in a row with the same anchor are one run.  Equal windows have equal anchors, so an
   anchor that stands in one document alone clears its runs; only those of repeated anchors go on.
2. The bytes of the runs that go on are the strings of the column-wise construction (``column_bwt``), aligned
   at their anchors, so that equal windows begin in one column.  A bucket of anchors is one group, cut by
   anchor into blocks of about ``BLOCK`` strings.  When the rounds come to the column of a window, neighbours that
   share ``WINDOW`` bytes are one set of equal windows; the smallest id of each set stays, every other window of it is removed.

Both shuffles meet hot passages after combining: a task looks at ``CHUNK`` bytes of texts at a time and sends, per
anchor or string, the rows of its smallest id alone.  What a chunk can tell by itself (a repeated
anchor, a string of a smaller id) goes past the group untouched.  An anchor with more than ``hot``
runs in all sends its windows one by one, by their own hash, so that no group holds all strings around a passage.

Defined results: a null text is empty; empty texts and those under ``WINDOW`` bytes keep all.  Very long texts are taken
whole.  Rows that share an id neither clear nor remove each other.  A row without an id removes nothing
and keeps all.  Repeated rows give one result each.  An empty table gives an empty result.  Columns beside
doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from codetide.llm.column_bwt import aligned, rounds
from codetide.llm.common import BROADCAST_KEYS, bounded
from codetide.session import StagingArea, stage

WINDOW = 50
ANCHOR = 20
# places of an anchor in a window, columns of strings aligned at it
SLIDE = WINDOW - ANCHOR + 1
COLUMNS = SLIDE - 1 + WINDOW
CHUNK = 6 << 20
BLOCK = 16384
# what a group holds: text bytes behind the anchors of a bucket, windows of its strings, text bytes of a part of the documents
BYTES_PER_BUCKET = 16 << 20
WINDOWS_PER_BUCKET = 3 << 20
BYTES_PER_PART = 8 << 20
# ranges that may go to every task, in bytes
BROADCAST_BYTES = 32 << 20
HOT_RUNS = 1 << 18
HOT_ANCHORS = 100_000

# a row of a bucket, or ranges of a part of the documents on their way past the buckets
_SENT = "bucket int, part int, body binary"
# ranges of a part of the documents, or a hot anchor
_FOUND = "part int, body binary, anchor long, runs long"
_ROWS = "doc_id long, copy long, body binary, width long"
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)


# --- anchors ------------------------------------------------------------------------------------


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on, from those of half the width."""
    power = lambda e: _U(pow(_STEP, e, 1 << 64))
    piece, size, whole, taken = _BYTES[data], 1, None, 0
    while True:
        if width & size:
            if whole is None:
                whole = piece
            else:
                n = max(len(data) - taken - size + 1, 0)
                whole = whole[:n] * power(size) + piece[taken : taken + n]
            taken += size
        if 2 * size > width:
            break
        n = max(len(piece) - size, 0)
        piece = piece[:n] * power(size) + piece[size:]
        size *= 2
    return _mixed(whole)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Other values, equal where they were equal, spread evenly."""
    values = (values ^ (values >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return values ^ (values >> _U(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values in a row, from each place on."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: max(len(values) - size, 0)], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: max(len(values) - rest, 0)], values[rest:]) if rest else values


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor in texts lying end to end: place, number of windows, place of the anchor, its hash."""
    hashes = _hashes(data, ANCHOR)
    # the upper half of a hash and the place: the least is the first of the least
    low = _U((1 << 32) - 1)
    anchor = _least((hashes & ~low) | np.arange(len(hashes), dtype=_U), SLIDE) & low
    inside = np.arange(len(anchor)) + WINDOW <= np.repeat(offsets[1:], np.diff(offsets))[: len(anchor)]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, _U)
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    at = np.flatnonzero(first)
    before = np.concatenate(([0], np.cumsum(inside)))
    windows = before[np.append(at[1:], len(anchor))] - before[at]
    anchor = anchor[at].astype(np.int64)
    # least hashes are small numbers: buckets need even ones
    return at, windows, anchor, _mixed(hashes[anchor])


# --- rows of a group, as bytes ---------------------------------------------------------------------


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, those of equal weight in a number side by side, so that a shuffle compresses them."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return np.int64(len(columns[0])).tobytes() + b"".join(planes)


def _unpack(body: bytes, *kinds: str) -> tuple[list[np.ndarray], bytes]:
    """The columns of ``_pack``, and the bytes after them."""
    count, at, found = int(np.frombuffer(body, np.int64, 1)[0]), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8, count * width, at).reshape(width, count)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += count * width
    return found, body[at:]


def _groups(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of sorted ``keys`` with where it stands."""
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
    for a, b in zip(begins, np.append(begins[1:], len(keys)) if len(keys) else []):
        yield keys[a], slice(int(a), int(b))


def _of(part: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash: its upper half, scaled."""
    return ((part >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with the bytes of their texts end to end and where each begins, ``CHUNK`` bytes or one text at a time."""
    for batch in batches:
        text = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        values = text.buffers()[2]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        begin = 0
        while begin < len(batch):
            end = max(int(np.searchsorted(offsets, offsets[begin] + CHUNK, "right")) - 1, begin + 1)
            yield batch.slice(begin, end - begin), data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
            begin = end


def _long(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("body", pa.binary())])
_FOUND_ARROW = pa.schema([("part", pa.int32()), ("body", pa.binary()), ("anchor", pa.int64()), ("runs", pa.int64())])
_ROWS_ARROW = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("body", pa.binary()), ("width", pa.int64())])


# --- ranges of documents -----------------------------------------------------------------------------


def _joined(doc: np.ndarray, copy: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges by document and start, those that overlap or touch made one: doc_id, copy, start, end."""
    row = np.unique(doc, return_inverse=True)[1].astype(np.int64)
    if copy.any():
        row = np.unique(row * (len(doc) + 1) + np.unique(copy, return_inverse=True)[1], return_inverse=True)[1].astype(np.int64)
    # places as if the documents lay one behind the other: what is joined never reaches into the next
    start, end = (row << 32) + start, (row << 32) + end
    order = np.argsort(start)
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.append(True, start[1:] > reach[:-1])) if len(order) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(order)) - 1
    low = (1 << 32) - 1
    return doc[order[first]], copy[order[first]], start[first] & low, reach[last] & low


def _by_part(doc: np.ndarray, copy: np.ndarray, start: np.ndarray, end: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    """Ranges, joined, as one body per part of the documents."""
    if not len(doc):
        return []
    doc, copy, start, end = _joined(doc, copy, start, end)
    part = _of(_mixed(doc.view(_U) * _U(_STEP)), parts)
    order = np.argsort(part, kind="stable")
    return [
        (int(number), _pack(doc[order[s]], copy[order[s]], start[order[s]].astype(np.int32), end[order[s]].astype(np.int32)))
        for number, s in _groups(part[order])
    ]


def _join_part(table: pa.Table) -> pa.Table:
    """All ranges of each document of a part as one row, with their total width."""
    parts = [_unpack(body.as_py(), "i8", "i8", "i4", "i4")[0] for body in table["body"]]
    doc, copy, start, end = _joined(*(x.astype(np.int64) for x in map(np.concatenate, zip(*parts))))
    begins = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])))
    whole = np.stack((start, end), axis=1).astype(np.int32).tobytes()
    edges = np.append(begins, len(doc)) * 8
    bodies = [whole[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    columns = (doc[begins], copy[begins], bodies, np.add.reduceat(end - start, begins))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS_ARROW)], schema=_ROWS_ARROW)


def _pairs(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of a document's ranges."""
    pairs = np.frombuffer(body, np.int32).reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1]


def _split(table: pa.Table) -> tuple[list[bytes], list[tuple]]:
    """A bucket's own rows, and the ranges that only pass it."""
    own = table.filter(table["part"].is_null())["body"]
    told = table.filter(table["part"].is_valid())
    return [b.as_py() for b in own], [(p.as_py(), b.as_py(), None, None) for p, b in zip(told["part"], told["body"])]


def _found(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, _FOUND_ARROW)] if rows else [], _FOUND_ARROW)


# --- step 1: anchors that stand in several documents -------------------------------------------------


def _send_anchors(buckets: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _texts(batches):
            at, windows, _, anchor = runs(data, offsets)
            if not len(at):
                continue
            row = np.searchsorted(offsets, at, "right") - 1
            start = at - offsets[row]
            ids, copies = _long(rows, "doc_id"), _long(rows, "copy")
            doc, copy = ids[row], copies[row]
            order = np.argsort(anchor)
            begins, sizes, several = _several(anchor[order], doc[order])
            inside = np.empty(len(order), bool)
            inside[order] = np.repeat(several, sizes)
            told = _by_part(doc[inside], copy[inside], start[inside], (start + windows)[inside], parts)
            out = [(part % buckets, part, body) for part, body in told]
            # an anchor of several documents is one row without windows, with the number of its runs
            some = order[begins[several]]
            start[some], windows[some] = sizes[several], 0
            shown = ~inside
            shown[some] = True
            order = order[shown[order]]
            row, start, windows, anchor = row[order], start[order], windows[order], anchor[order]
            for bucket, s in _groups(_of(anchor, buckets)):
                body = _pack(anchor[s], ids[row[s]], copies[row[s]], start[s].astype(np.int32), windows[s].astype(np.int8))
                out.append((int(bucket), None, body))
            yield _batch(out, _SENT_ARROW)

    return run


def _several(anchor: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by anchor: where each anchor begins, its number of rows, whether they are of several documents."""
    begins = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    least, most = np.minimum.reduceat(doc, begins), np.maximum.reduceat(doc, begins)
    return begins, np.diff(np.append(begins, len(anchor))), least != most


def _repeated_anchors(parts: int, hot: int):
    """Of a bucket: ranges of windows whose anchor stands in several documents; hot anchors."""

    def run(table: pa.Table) -> pa.Table:
        own, out = _split(table)
        if own:
            columns = [_unpack(body, "u8", "i8", "i8", "i4", "i1")[0] for body in own]
            anchor, doc, copy, start, windows = map(np.concatenate, zip(*columns))
            order = np.argsort(anchor)
            anchor, doc, start, windows = anchor[order], doc[order], start[order].astype(np.int64), windows[order]
            begins, sizes, several = _several(anchor, doc)
            several |= np.logical_or.reduceat(windows == 0, begins)
            times = np.add.reduceat(np.where(windows == 0, start, 1), begins)
            inside = np.repeat(several, sizes) & (windows > 0)
            told = _by_part(doc[inside], copy[order[inside]], start[inside], start[inside] + windows[inside], parts)
            out += [(part, body, None, None) for part, body in told]
            out += [(None, None, int(a), int(n)) for a, n in zip(anchor[begins].view(np.int64), times) if n > hot]
        return _found(out)

    return run


# --- step 2: equal windows among the strings of a bucket ----------------------------------------------


def _send_strings(buckets: int, parts: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _texts(batches):
            ids, copies = _long(rows, "doc_id"), _long(rows, "copy")
            # the texts of the ranges, end to end: windows of a range need WINDOW - 1 bytes more
            begin, end, row = [], [], []
            for n, body in enumerate(rows.column("body")):
                a, b = _pairs(body.as_py())
                begin.append(a)
                end.append(b + WINDOW - 1)
                row.append(np.full(len(a), n))
            begin, end, row = map(np.concatenate, (begin, end, row))
            bounds = np.concatenate(([0], np.cumsum(end - begin)))
            place = np.arange(bounds[-1]) + np.repeat(offsets[row] + begin - bounds[:-1], end - begin)
            data = data[place]
            at, windows, anchor, key = runs(data, bounds)
            if len(hot):
                apart = np.isin(key, hot)
                each = np.where(apart, windows, 1)
                turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                single = np.repeat(apart, each)
                at, anchor, key = np.repeat(at, each) + turn, np.repeat(anchor, each), np.repeat(key, each)
                windows = np.where(single, 1, np.repeat(windows, each))
                key[single] = _hashes(data, WINDOW)[at[single]]
            of = np.searchsorted(bounds, at, "right") - 1
            row, start = row[of], at - bounds[of] + begin[of]
            size = windows + WINDOW - 1
            yield from _strings(data, at, size, anchor - at, key, ids[row], copies[row], start, buckets, parts)

    return run


def _strings(data, at, size, shift, key, doc, copy, start, buckets, parts) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: strings of their smallest id to their buckets, ranges of larger ids past them."""
    whole = data.tobytes()
    smallest: dict[bytes, int] = {}
    texts = [whole[a:b] for a, b in zip(at.tolist(), (at + size).tolist())]
    for text, number in zip(texts, doc.tolist()):
        known = smallest.setdefault(text, number)
        if number < known:
            smallest[text] = number
    least = np.fromiter((smallest[text] for text in texts), np.int64, len(texts))
    gone = doc > least
    told = _by_part(doc[gone], copy[gone], start[gone], (start + size)[gone], parts)
    out = [(part % buckets, part, body) for part, body in told]
    stay = np.flatnonzero(~gone)
    stay = stay[np.argsort(_of(key[stay], buckets), kind="stable")]
    # a part of the hash that the bucket does not follow from tells the block
    part = (key[stay] & _U(255)).astype(np.uint8)
    for bucket, s in _groups(_of(key[stay], buckets)):
        some = stay[s]
        plain = _pack(size[some].astype(np.uint8), shift[some].astype(np.uint8), part[s], doc[some], copy[some], start[some].astype(np.int32))
        plain += b"".join(texts[i] for i in some.tolist())
        body = len(plain).to_bytes(8, "big") + pa.compress(plain, "zstd", asbytes=True)
        out.append((int(bucket), None, body))
    if out:
        yield _batch(out, _SENT_ARROW)


def earlier_windows(texts: list[bytes], shift: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every string, the smallest owner of an equal window; and where each string's windows begin.

    ``shift`` is the place of a string's anchor.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    windows, column = lengths - WINDOW + 1, SLIDE - 1 - shift.astype(np.int64)
    begins = np.cumsum(windows) - windows
    least = np.empty(windows.sum(), np.int64)
    layout = aligned(np.frombuffer(b"".join(texts), np.uint8), lengths, column, COLUMNS)
    for at, order, common in rounds(layout, WINDOW):
        turn = at - column[order]
        asked = (turn >= 0) & (turn < windows[order])
        if asked.any():
            # neighbours that share a window are one set
            change = common < WINDOW
            change[0] = True
            smallest = np.minimum.reduceat(owner[order], np.flatnonzero(change))
            strings = order[asked]
            least[begins[strings] + turn[asked]] = smallest[np.cumsum(change)[asked] - 1]
    return least, begins


def _repeated_windows(parts: int):
    """Of a bucket: byte ranges of the windows that stand in a document with a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        own, out = _split(table)
        columns, texts, gone = [], [], []
        for packed in own:
            plain = pa.decompress(packed[8:], int.from_bytes(packed[:8], "big"), "zstd", asbytes=True)
            found, rest = _unpack(plain, "u1", "u1", "u1", "i8", "i8", "i4")
            ends = np.cumsum(found[0].astype(np.int64))
            texts += [rest[a:b] for a, b in zip((ends - found[0]).tolist(), ends.tolist())]
            columns.append(found)
        if texts:
            size, shift, part, doc, copy, start = map(np.concatenate, zip(*columns))
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
            # whole parts of the hash together until they hold a block's worth
            edges = np.append(cuts[np.unique(cuts // BLOCK, return_index=True)[1]], len(order))
            for a, b in zip(edges[:-1], edges[1:]):
                some = order[a:b]
                row, at = _later(texts, some, size[some].astype(np.int64), shift[some], doc[some])
                gone.append((doc[some[row]], copy[some[row]], start[some[row]].astype(np.int64) + at))
            doc, copy, start = map(np.concatenate, zip(*gone))
            out += [(*told, None, None) for told in _by_part(doc, copy, start, start + WINDOW, parts)]
        return _found(out)

    return run


def _later(texts: list[bytes], some: np.ndarray, size: np.ndarray, shift: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's rows: the row and the place in its string of each window that a smaller id has."""
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(texts[i], len(number)) for i in some.tolist()), np.int64, len(some))
    owner = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(owner, which, doc)
    place = np.empty(len(number), np.uint8)
    place[which] = shift  # equal strings have their anchor in one place
    least, begins = earlier_windows(list(number), place, owner)
    windows = size - WINDOW + 1
    turn = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    row = np.repeat(np.arange(len(some)), windows)
    gone = least[begins[which][row] + turn] < doc[row]
    return row[gone], turn[gone]


# --- what is left ---------------------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("body").to_pylist()):
            start, end = _pairs(body or b"")
            left = [text[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(text)])]
            kept = b"".join(left)
            spans = [{"begin": a, "end": b} for a, b in zip(start.tolist(), end.tolist())]
            rows.append((doc, len(text), len(text) - len(kept), len(start), hashlib.sha256(kept).hexdigest(), spans, kept))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _CUT_ARROW)], schema=_CUT_ARROW)


_CUT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        ("kept", pa.binary()),
    ]
)
_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:int,end:int>>, kept binary"


def _hottest(found: DataFrame) -> np.ndarray:
    """Anchors with the most runs, at most ``HOT_ANCHORS`` of them."""
    top = found.filter("anchor is not null").groupBy("anchor").agg(F.sum("runs").alias("runs")).orderBy(F.desc("runs"), "anchor")
    return np.array([r["anchor"] for r in top.limit(HOT_ANCHORS).collect()], np.int64).view(_U)


def _per_row(found: DataFrame, label: str, area: StagingArea) -> DataFrame:
    """Staged: one row per document with all its ranges."""
    together = found.filter("part is not null").select("part", "body").groupBy("part")
    return stage(together.applyInArrow(_join_part, _ROWS), label, area)


def _beside(ranges: DataFrame) -> DataFrame:
    """Ranges marked for a join with the texts: to every task while they are few and small, merged beyond."""
    rows, size = ranges.agg(F.count("*"), F.sum(F.length("body"))).first()
    small = rows <= BROADCAST_KEYS and (size or 0) <= BROADCAST_BYTES
    return F.broadcast(ranges) if small else ranges.hint("merge")


def remove_repeats(docs: DataFrame, area: StagingArea, hot: int = HOT_RUNS) -> DataFrame:
    """Rows of ``docs(doc_id, text)`` as doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (of bytes removed) and kept (the bytes left)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # rows that share an id are told apart by their texts
    twice = docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("__twice"))
    twice = bounded(stage(twice, "twice", area))
    docs = docs.join(twice, F.col("doc_id") == F.col("__twice"), "left").select(
        "doc_id", F.when(F.col("__twice").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0)).alias("copy"), "text"
    )
    long = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = total // BYTES_PER_PART + 1
    sent = long.mapInArrow(_send_anchors(total // BYTES_PER_BUCKET + 1, parts), _SENT)
    found = stage(sent.groupBy("bucket").applyInArrow(_repeated_anchors(parts, hot), _FOUND), "anchors", area)
    ranges = _per_row(found, "ranges", area)
    width = ranges.agg(F.sum("width")).first()[0] or 0
    taken = long.join(_beside(ranges.drop("width")), ["doc_id", "copy"]).select("doc_id", "copy", "text", "body")
    strings = taken.mapInArrow(_send_strings(width // WINDOWS_PER_BUCKET + 1, parts, _hottest(found)), _SENT)
    spans = _per_row(strings.groupBy("bucket").applyInArrow(_repeated_windows(parts), _FOUND), "spans", area)
    return docs.join(_beside(spans.drop("width")), ["doc_id", "copy"], "left").select("doc_id", "text", "body").mapInArrow(_cut, _CUT)
