"""The audit against plain flags, orders and counts; the sketch against what it may clear."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codetide.llm import filter_audit
from codetide.session import StagingArea

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def area(spark):
    made = StagingArea(spark)
    yield made
    made.release()


def plain(rows):
    """Failed filters of (doc_id, text, lang), by the contract's words."""
    out = []
    for i, t, lang in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = ""
        fails += "A" if len(words) < 200 else ""
        fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else ""
        fails += "D" if re.search("[#$%&*|]", t) else ""
        earlier = [j for j, u, _ in rows if (u or "") == t and j is not None and i is not None and j < i]
        out.append((i, lang or "", fails + ("E" if earlier else "")))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    flags, out = plain(rows), {}
    for part in {p for _, p, _ in flags}:
        own = [(i, f) for i, p, f in flags if p == part]
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                total[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for _, f in own) - len(gone), sum(f == name for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(df, labels, area):
    rows = filter_audit.audit(df, labels, area).collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}
    assert len(got) == len(rows)
    return got


LONG = " ".join(f"word{n}" for n in range(40000))
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n\x0b\x0c\r ", None), (4, LONG, "fr"), (5, LONG, "en"), (5, LONG, "fr"), (-1, "a b c", "en"),
    (6, "a b c", "en"), (7, "A B C", ""), (8, "a\x1cb\x85c d " * 80, "en"), (9, "x # y", "fr"), (None, "a b c", "en"), (None, "alone", "en"),
    (10, "word " * 300, "fr"), (11, "word " * 300, "fr"), (12, " ".join(f"É{n}" for n in range(250)), "de"), (13, " ".join(f"A{n} bbbbbbbbb" for n in range(250)), "de"),
    (14, "　".join("ab" * 5 for _ in range(300)), "de"), (15, "one|two", "de"), (16, "|", "de"), (16, "|", "de"),
]
LABELS = [(1, 1, 0), (4, 0, 1), (5, 1, None), (5, 0, 1), (6, 1, 1), (None, 1, 1), (11, None, 1), (99, 1, 1), (13, 1, 0)]


def test_audit_is_that_of_plain_flags(spark, area):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in ROWS], "doc_id long, text string, lang string, mask int, digest string, part string")
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, rows string")
    assert found(df.repartition(3), labels, area) == brute(ROWS, LABELS)


def test_masks(spark, area):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    got = Counter((r["doc_id"], r["part"], r["mask"]) for r in filter_audit.masks(df, area).collect())
    assert got == Counter((i, p, sum(1 << "ABCDE".index(f) for f in fails)) for i, p, fails in plain(ROWS))


def test_sketch_keeps_every_repeat_and_clears_most_others(spark, area):
    texts = [f"text {n % 4000 if n < 8000 else n}" for n in range(12000)]  # 4,000 twice, 4,000 once
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7).select(F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    kept = {bytes(r["digest"]) for r in filter_audit._possible(df, area).collect()}
    digest = {r["text"]: bytes(r["digest"]) for r in df.collect()}
    assert all(digest[f"text {n}"] in kept for n in range(4000))
    assert sum(digest[f"text {n}"] in kept for n in range(8000, 12000)) < 200


def test_sketch_beyond_broadcast_and_in_small_pieces(spark, area, monkeypatch):
    monkeypatch.setattr(filter_audit, "BROADCAST_BLOCKS", 0)
    monkeypatch.setattr(filter_audit, "CELLS_PER_ROW", 2000)
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert found(df, labels, area) == brute(ROWS, LABELS)


def test_empty_tables(spark, area):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels, area).count() == 0
    some = spark.createDataFrame(ROWS, docs.schema)
    assert found(some, labels, StagingArea(spark)) == brute(ROWS, [])
