"""Repeated passages against a plain set of windows, the column-wise transform against sorted suffixes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codetide.llm import suffix_dedup
from codetide.llm.column_bwt import aligned, rounds
from codetide.llm.common import table
from codetide.session import StagingArea

W = suffix_dedup.WINDOW


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of every row, by all windows of all texts."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        if i is not None:
            for at in range(len(t) - W + 1):
                w = t[at : at + W]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for at in range(len(t) - W + 1):
            if i is not None and first[t[at : at + W]] < i:
                gone[at : at + W] = b"\1" * W
        spans = sum(1 for n, g in enumerate(gone) if g and (n == 0 or not gone[n - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, area, **more):
    left = suffix_dedup.remove_repeats(df, area, **more)
    rows = [tuple(r) for r in left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    return sorted(rows, key=str)


@pytest.fixture
def area(spark):
    made = StagingArea(spark)
    yield made
    made.release()


def test_rounds_sort_the_suffixes_of_every_column():
    some = random.Random(3)
    for _ in range(80):
        strings = [bytes(some.choices(b"abc"[: some.randint(1, 3)], k=some.randint(0, 40))) for _ in range(some.randint(1, 30))]
        begins = np.array([some.randint(0, 12) for _ in strings])
        lengths, cap = np.array([len(s) for s in strings]), some.randint(2, 25)
        layout = aligned(np.frombuffer(b"".join(strings), np.uint8), lengths, begins, 60)
        for column, order, common in rounds(layout, cap):
            # a string without a symbol in a column sorts before those with one
            rest = [[0] * max(begins[n] - column, 0) + [b + 1 for b in s[max(column - begins[n], 0) :]] for n, s in enumerate(strings)]
            rest = [r + [0] * (60 - column - len(r)) for r in rest]
            assert sorted(order.tolist()) == list(range(len(strings)))
            assert [rest[n] for n in order] == sorted(rest)
            shared = [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y or x == 0), len(a)) for a, b in zip([rest[n] for n in order], [rest[n] for n in order[1:]])]
            assert common.tolist() == [0] + [min(n, cap) for n in shared]


def odd_rows():
    some = random.Random(11)
    word = lambda: "".join(some.choices("aeiouklmnprst", k=some.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, notice = text(30), "é中" * 40
    rows = [(n, f"{text(some.randint(1, 60))} {passage if n % 3 == 0 else ''} {text(20)} {notice if n % 4 == 0 else ''}") for n in range(-5, 60)]
    rows += [(100 + n, rows[7][1]) for n in range(5)] + [(200, rows[9][1][13:]), (201, rows[9][1][:-17] + "x")]
    rows += [(300, "a" * 5000), (301, "b" + "a" * 400), (302, "ab" * 300), (303, "ba" * 200), (304, "a" * W), (305, "a" * (W - 1))]
    rows += [(400, None), (401, ""), (None, passage), (None, None), (7, passage), (7, passage), (7, rows[3][1]), (402, "\0" * 200), (403, "\0" * 60)]
    rows += [(500, text(40000)), (501, None)]
    return rows + [(502, rows[-2][1][1000:90000])]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_RUNS, 3])
def test_removed_bytes_are_those_of_all_windows(spark, area, monkeypatch, hot):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, body string, copy string").repartition(5)
    assert found(df, area, hot=hot) == brute(rows)


def test_many_small_buckets_and_blocks(spark, area, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BYTES_PER_BUCKET", 5000)
    monkeypatch.setattr(suffix_dedup, "WINDOWS_PER_BUCKET", 900)
    rows = odd_rows()
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), area) == brute(rows)


def test_windows_of_a_block():
    texts = [t.encode() for _, t in odd_rows() if t and len(t) < 3000]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    at, windows, anchor, _ = suffix_dedup.runs(data, offsets)
    # every window is in one run, with an anchor that the window's own bytes tell
    assert sum(windows) == sum(max(len(t) - W + 1, 0) for t in texts) and windows.max() <= suffix_dedup.SLIDE
    strings = sorted({(data[a : a + n + W - 1].tobytes(), int(p - a)) for a, n, p in zip(at, windows, anchor)})
    assert len({t for t, _ in strings}) == len(strings)
    owner = np.random.default_rng(2).integers(0, 50, len(strings))
    first = {}
    for (t, _), o in zip(strings, owner):
        for place in range(len(t) - W + 1):
            first[t[place : place + W]] = min(first.get(t[place : place + W], o), o)
    least, begins = suffix_dedup.earlier_windows([t for t, _ in strings], np.array([p for _, p in strings]), owner)
    assert least.tolist() == [first[t[place : place + W]] for t, _ in strings for place in range(len(t) - W + 1)]


def test_given_documents(spark, area):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    assert found(docs, area) == brute([tuple(r) for r in docs.collect()])


def test_spans_and_bytes_left(spark, area):
    passage = "".join(chr(97 + n * 7 % 26) for n in range(80)) + "1234567890" * 3
    left = suffix_dedup.remove_repeats(spark.createDataFrame([(1, passage), (2, f"head {passage} tail")], "doc_id long, text string"), area)
    row = left.filter("doc_id = 2").first()
    assert [tuple(s) for s in row["spans"]] == [(5, 5 + len(passage))] and bytes(row["kept"]) == b"head  tail"


def test_empty_table(spark, area):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert found(none, area) == [] and suffix_dedup.remove_repeats(none.withColumn("x", F.lit(1)), StagingArea(spark)).count() == 0
