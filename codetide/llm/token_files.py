"""Token ids in binary files of patched frame-of-reference blocks.

Documents are dealt into ranges of id and sorted; each task encodes its range and writes one file.
The ids of a file, an end id after each document, are cut into blocks of ``BLOCK``.  A block stores
its minimum, the differences to it packed at the width that ``PERCENTILE`` of them need, and the
rest as exceptions: place and the bits above that width.  An index holds every block's start, so any
block can be read alone.

File, all numbers little-endian:

    magic "PFR1", uint32 documents, uint64 ids, uint32 blocks
    int64 doc_id and uint8 null flag, then uint32 count, for every document (three arrays)
    uint64 start of every block from the begin of the data, then one past the last
    data: per block uint32 minimum, uint8 width, uint16 exceptions, then words, places, high bits

A task writes under a name of its own, and the names that count are those in the job's result, so
a task that is lost and repeated, or runs twice, leaves at worst a file nobody reads.  Files are
read back through Spark.

Encoding one text costs most; what a text is made of between white space is encoded by itself and
remembered, which gives the same ids, since this tokenizer never joins across white space.

Defined results: a null text is an empty one, and an empty text is the end id alone.  Rows of equal id
are ordered by text; null ids come first.  Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, Window, functions as F

from codetide.llm.common import tasks
from codetide.session import StagingArea, stage

MAGIC = b"PFR1"
BLOCK = 256
PERCENTILE = 0.9
END_ID = 1
CACHE = 400_000
FILE_IDS = 1 << 23
SPLIT = re.compile(r"[ \t\r\n]+")
# letters of Latin-1 that are one character in every normal form
LATIN = "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
SIMPLE = re.compile(f"[!-~{LATIN}]+")
# fixed values: the tokenizer's own pattern, for such words in lower case
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
HEAD = np.dtype([("minimum", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


# --- blocks -----------------------------------------------------------------


def widths(differences: np.ndarray) -> np.ndarray:
    """Per row, the bits that the chosen share of the differences fit in."""
    at = int(np.ceil(PERCENTILE * differences.shape[1])) - 1
    chosen = np.partition(differences, at, axis=1)[:, at]
    return np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values below 2**width as rows of uint64 words, four lanes side by side."""
    rows = values.shape[0]
    words = np.zeros((rows, max(1, width), 4), np.uint64)
    lanes = values.reshape(rows, BLOCK // 4, 4)
    for j in range(BLOCK // 4 if width else 0):
        word, shift = divmod(j * width, 64)
        words[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return words[:, :width].reshape(rows, width * 4)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = words.shape[0]
    words = words.reshape(rows, width, 4)
    values = np.zeros((rows, BLOCK // 4, 4), np.uint64)
    for j in range(BLOCK // 4 if width else 0):
        word, shift = divmod(j * width, 64)
        values[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            values[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    return (values & np.uint64((1 << width) - 1)).reshape(rows, BLOCK)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Data of all blocks, and the start of each with the end last.

    A last block that is not full is filled up with its own last id.
    """
    if not len(ids):
        return b"", np.zeros(1, np.uint64)
    padded = np.concatenate((ids, np.full(-len(ids) % BLOCK, ids[-1], ids.dtype))).reshape(-1, BLOCK)
    least = padded.min(axis=1)
    differences = (padded - least[:, None]).astype(np.uint64)
    width = widths(differences)
    high = differences >> width[:, None].astype(np.uint64)
    row, place = np.nonzero(high)
    exceptions = np.bincount(row, minlength=len(padded))
    sizes = HEAD.itemsize + width.astype(np.int64) * 32 + exceptions * 5
    starts = np.concatenate(([0], np.cumsum(sizes)))
    data = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros(len(padded), HEAD)
    head["minimum"], head["width"], head["exceptions"] = least, width, exceptions
    _put(data, starts[:-1], head.view(np.uint8).reshape(len(padded), -1))
    low = differences & ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None]
    for w in np.unique(width):
        if w:
            of = np.flatnonzero(width == w)
            _put(data, starts[of] + HEAD.itemsize, pack(low[of], int(w)).astype("<u8").view(np.uint8))
    first = starts[row] + HEAD.itemsize + width[row].astype(np.int64) * 32
    nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    data[first + nth] = place
    _put(data, first + exceptions[row] + nth * 4, high[row, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return data.tobytes(), starts.astype(np.uint64)


def decode_blocks(data: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of blocks at the given starts."""
    raw, at = np.frombuffer(data, np.uint8), starts[:-1].astype(np.int64)
    if not len(at):
        return np.empty(0, np.uint32)
    head = _take(raw, at, HEAD.itemsize).copy().view(HEAD).ravel()
    width, exceptions = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    values = np.empty((len(at), BLOCK), np.uint64)
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        packed = _take(raw, at[of] + HEAD.itemsize, int(w) * 32)
        values[of] = unpack(packed.copy().view("<u8"), int(w)) if w else 0
    row = np.repeat(np.arange(len(at)), exceptions)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    first = at[row] + HEAD.itemsize + width[row] * 32
    high = _take(raw, first + exceptions[row] + nth * 4, 4).copy().view("<u4").ravel()
    values[row, raw[first + nth]] |= high.astype(np.uint64) << width[row].astype(np.uint64)
    return (values + head["minimum"][:, None]).ravel()[:n].astype(np.uint32)


def _put(data: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    if rows.size:
        data[at[:, None] + np.arange(rows.shape[1])] = rows


def _take(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    return data[at[:, None] + np.arange(size)]


# --- files ------------------------------------------------------------------


def file_bytes(docs: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of the documents' ids, in the order given."""
    data, starts = encode_blocks(ids)
    head = np.array([(len(docs), len(ids), len(starts) - 1)], np.dtype([("docs", "<u4"), ("ids", "<u8"), ("blocks", "<u4")]))
    return b"".join(
        [
            MAGIC,
            head.tobytes(),
            np.array([d or 0 for d in docs], "<i8").tobytes(),
            np.array([d is None for d in docs], "u1").tobytes(),
            counts.astype("<u4").tobytes(),
            starts.astype("<u8").tobytes(),
            data,
        ]
    )


@dataclass(frozen=True)
class TokenFile:
    """What is in a file: documents, ids per document, and its blocks."""

    docs: list[int | None]
    counts: np.ndarray
    n_ids: int
    starts: np.ndarray
    data: bytes

    @classmethod
    def parse(cls, content: bytes) -> TokenFile:
        if content[:4] != MAGIC:
            raise ValueError("not a file of token ids")
        docs, ids, blocks = np.frombuffer(content, np.dtype([("docs", "<u4"), ("ids", "<u8"), ("blocks", "<u4")]), 1, 4)[0]
        at, parts = 20, []
        for kind, n in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u8", int(blocks) + 1)):
            parts.append(np.frombuffer(content, kind, int(n), at))
            at += parts[-1].nbytes
        names = [None if null else int(d) for d, null in zip(parts[0], parts[1])]
        return cls(names, parts[2], int(ids), parts[3], content[at:])

    def ids(self) -> np.ndarray:
        return decode_blocks(self.data, self.starts, self.n_ids)

    def block(self, i: int) -> np.ndarray:
        """One block, found by its start."""
        lo, hi = int(self.starts[i]), int(self.starts[i + 1])
        return decode_blocks(self.data[lo:hi], np.array([0, hi - lo], np.uint64), min(BLOCK, self.n_ids - i * BLOCK))


# --- encoding ---------------------------------------------------------------


class Encoder:
    """The tokenizer with bounded memories for words and for the pieces that words fall into.

    A word of ASCII signs and Latin-1 letters is cut here as the tokenizer's own pattern cuts it, and
    its pieces go to the tokenizer's model in the characters its byte-level step gives.  Any other
    word, and one that might hold a special token, goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        step = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.as_bytes = {ord(c): "".join(part for part, _ in step(c)) for c in LATIN if ord(c) > 127}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            ids = [t.id for t in self.model.tokenize(piece.translate(self.as_bytes))]
            known = self.pieces[piece] = np.array(ids, "<u4").tobytes()
        return known

    def _word(self, word: str) -> bytes:
        if SIMPLE.fullmatch(word) and "<|" not in word:
            return b"".join(map(self._piece, PIECE.findall(word.lower())))
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit numbers."""
        found, known = [], self.words
        for word in SPLIT.split(text):
            ids = known.get(word)
            if ids is None:
                if len(known) >= CACHE:
                    known.clear()
                ids = known[word] = self._word(word)
            found.append(ids)
        return b"".join(found)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker: tasks that follow each other there share what is remembered."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _write(folder: str, tokenizer: str):
    """Encode a range of documents; a new file begins whenever ``FILE_IDS`` ids are in hand."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer).encode, np.array([END_ID], "<u4").tobytes()
        docs: list[int | None] = []
        parts: list[bytes] = []
        piece, part, held = 0, 0, 0

        def flush() -> pd.DataFrame:
            counts = np.array([len(p) // 4 for p in parts])
            content = file_bytes(docs, counts, np.frombuffer(b"".join(parts), "<u4"))
            store, place = pyarrow.fs.FileSystem.from_uri(folder)
            store.create_dir(place, recursive=True)
            name = f"{piece:06d}-{part:04d}-{uuid.uuid4().hex}.pfr"
            with store.open_output_stream(f"{place}/{name}") as out:
                out.write(content)
            row = {"piece": [piece], "part": [part], "file": [name], "n_docs": [len(docs)], "n_ids": [int(counts.sum())]}
            docs.clear()
            parts.clear()
            return pd.DataFrame(row)

        for batch in batches:
            for doc, text, at in zip(batch["doc_id"], batch["text"], batch["piece"]):
                piece = int(at)
                docs.append(None if pd.isna(doc) else int(doc))
                parts.append(encode(text or "") + end)
                held += len(parts[-1]) // 4
                if held >= FILE_IDS:
                    yield flush()
                    part, held = part + 1, 0
        if docs:
            yield flush()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, area: StagingArea) -> DataFrame:
    """Write ``docs`` in ascending doc_id order; the table of files: piece, part, file, n_docs, n_ids, start."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # ranges of ids alone: the keys that Spark samples for them come to the driver, and texts must not
    dealt = docs.select("doc_id", "text").repartitionByRange(tasks(docs.sparkSession), order[0]).sortWithinPartitions(*order)
    marked = dealt.withColumn("piece", F.spark_partition_id())
    written = marked.mapInPandas(_write(folder, tokenizer), "piece int, part int, file string, n_docs long, n_ids long")
    earlier = Window.orderBy("piece", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return stage(written, "files", area).withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content, begin in zip(batch["content"], batch["start"]):
            file = TokenFile.parse(content)
            raw = memoryview(file.ids().astype("<u4").tobytes())
            ends = np.cumsum(file.counts.astype(np.int64))
            crcs = [zlib.crc32(raw[(e - c) * 4 : e * 4]) for e, c in zip(ends.tolist(), file.counts.tolist())]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(file.docs, "Int64"),
                    "start": begin + ends - file.counts,
                    "n_tokens": file.counts.astype(np.int64),
                    "ids_crc32": np.array(crcs, np.int64),
                }
            )


def read(files: DataFrame, folder: str) -> DataFrame:
    """Per document in the files: doc_id, start, n_tokens, ids_crc32."""
    spark = files.sparkSession
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfr").load(folder)
    named = stored.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    # a row per file, without contents
    counted = named.join(F.broadcast(files.select("file", "start")), "file").select("content", "start")
    return counted.mapInPandas(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, area: StagingArea) -> DataFrame:
    """Write the files, read them back."""
    folder = area.path("token-files")
    files = stage(write(docs, folder, tokenizer, area), "starts", area)
    if files.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(files, folder)
