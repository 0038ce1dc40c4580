"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import pytest
from pyspark.sql import functions as F

from codetide.llm import (
    embedding_dedup,
    fingerprint,
    language_id,
    licenses,
    mixing,
    ngram_join,
    packing,
    quality,
    sharding,
    token_files,
)
from codetide.session import StagingArea

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, slot string, "
    "score string, copy string, copies string, rate string, bucket string, width string, batch string, "
    "labels string, class string, piece string, position string, n_tokens_ string"
)
LONG = "A word, then others. " * 4000


def rows(pairs):
    return [(i, t, "en" if n % 2 else None, None if n % 3 == 0 else "s", 1, *["x"] * 15) for n, (i, t) in enumerate(pairs)]


ODD = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, LONG),
    (5, "Alpha beta gamma delta epsilon zeta"),
    (5, "Alpha beta gamma delta epsilon zeta"),
    (6, "alpha BETA gamma delta epsilon zeta"),
    (7, "Été 中文 \U0001f600 é"),
    (None, "a row without an id"),
    (-9, "1234 5678 !!"),
    (9, "one"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(rows(ODD), SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def area(spark):
    made = StagingArea(spark)
    yield made
    made.release()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language_id(docs, none):
    found = by_id(language_id.identify(docs, F.lit(False), F.lit(True)))
    assert [found[i]["lang_pred"] for i in (1, 2, 3, -9)] == ["und"] * 4
    assert found[7]["lang_pred"] == "en" and found[7]["score"] == 1.0
    assert language_id.identify(docs, F.lit(False), F.lit(True)).count() == len(ODD)
    assert {r["lang_pred"] for r in language_id.identify(docs, F.lit(False), F.lit(False)).collect()} == {"und"}
    assert language_id.identify(none, F.lit(False), F.lit(True)).count() == 0


def test_quality(spark, docs, none, area):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 1, 0), (7, 1, 0), (9, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, labels, F.lit(False), F.lit(True), area).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    scores = {r["doc_id"]: r["score"] for r in found}
    assert scores[1] == scores[2] and scores[5] < scores[4]
    same = quality.classify(docs, labels.filter("quality = 1"), F.lit(False), F.lit(True), StagingArea(spark)).collect()
    assert {round(r["score"], 9) for r in same} == {0.833333333}  # four rows of three ids, all good: (4 + 1) / (4 + 2)
    assert quality.classify(none, labels.limit(0), F.lit(False), F.lit(True), StagingArea(spark)).count() == 0


def test_ngram_join(docs, none, area, spark):
    found = ngram_join.join(docs, area).collect()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    assert len(found) == len(ODD)
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[9] == (1, 9)
    assert by[5] == (2, 5) and by[6] == (2, 5) and by[None] == (1, None)
    assert by[4][0] == 4  # a cycle of four words
    assert ngram_join.join(none, StagingArea(spark)).count() == 0


def test_near_copies_leave_other_rows_of_their_id(spark):
    import corpus_pipeline

    copied = "one two three four five six seven eight"
    table = [
        (1, copied), (None, copied.upper()), (None, "a clean text without an id"), (None, None),
        (4, copied.title()), (4, "another clean text with a repeated id"), (4, "another clean text with a repeated id"), (5, "alone"),
    ]
    kept = corpus_pipeline.by_similarity(spark, spark.createDataFrame(table, "doc_id long, text string"), "").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [table[k] for k in (0, 2, 3, 5, 7)]))


def test_sharding(docs, none, area, spark):
    found = sharding.shard(docs, 3, area).collect()
    assert len(found) == len(ODD)
    by = {r["doc_id"]: r for r in found}
    assert by[1]["size"] == 8 and by[1]["text_crc32"] == 0 and by[2]["size"] == 8
    assert len({(r["shard"], r["slot"]) for r in found}) == len(ODD)
    assert all(sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found))) for s in range(3))
    assert len({r["shard"] for r in found if r["doc_id"] == 5}) == 1
    assert sharding.shard(none, 3, StagingArea(spark)).count() == 0


def test_packing(docs, none, area, spark):
    sized = docs.withColumn("n_tokens", packing.n_tokens())
    found = packing.pack(sized, area, buckets=3, budget=100).collect()
    assert len(found) == len(ODD)
    by = {r["doc_id"]: r for r in found}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 1
    assert by[4]["n_tokens"] == 16001 and by[4]["slot"] == 0 and by[4]["padding"] == 0
    assert all(r["padding"] == r["width"] - r["n_tokens"] >= 0 for r in found)
    assert len({(r["batch"], r["slot"]) for r in found}) == len(ODD)
    assert packing.pack(none.withColumn("n_tokens", packing.n_tokens()), StagingArea(spark)).count() == 0


def test_licenses(docs, none, spark):
    found = by_id(licenses.scan(docs))
    assert found[1]["n_words"] == 0 and found[1]["labels"] == "" and found[1]["score"] == 0
    assert found[7]["n_words"] == 4  # the combining accent belongs to its word
    assert licenses.scan(docs).count() == len(ODD)
    assert licenses.scan(none).count() == 0
    more = spark.createDataFrame(
        [
            (1, "CC BY cc by-cc.BY, all rights. Reserved general public license"),
            (2, "x\nReleased, under the MIT License\ny"),
            (3, "Released under the License of MIT men"),
            (4, "released under a MIT license"),
            (5, "All rights éreserved. lİcense"),
        ],
        "doc_id long, text string",
    )
    found = by_id(licenses.scan(more))
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["last_word"]) == (5, 0, 9)
    assert found[1]["base_labels"] == "cc-by,gpl,reserved"
    assert found[2]["labels"] == "mit" and found[3]["labels"] == "mit" and found[4]["labels"] == "" and found[5]["labels"] == ""


def test_wrapped_licenses(spark):
    notices = {
        "mit-grant": (
            "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
            "of this software and associated documentation files (the \"Software\"), to deal\nin the Software."
        ),
        "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
        "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.",
    }
    texts = []
    for notice in notices.values():
        lines = notice.split("\n")
        texts += [notice, "\r\n".join(lines), "x = 1\n" + "\n".join(f"# {line}" for line in lines), notice.replace(" ", "\n")]
    apart = ["Released under\n\nthe MIT License", "Released under\r\n \r\nthe MIT License", "Released under it.\nThe MIT License"]
    found = by_id(licenses.scan(spark.createDataFrame(list(enumerate(texts + apart)), "doc_id long, text string")))
    assert [found[i]["labels"] for i in range(len(texts))] == [label for label in notices for _ in range(4)]
    assert all(found[i]["score"] >= 0.9 for i in range(len(texts)))
    assert [found[len(texts) + i]["labels"] for i in range(3)] == [""] * 3


def test_mixing(docs, none, spark):
    area = StagingArea(spark)
    found = mixing.replicate(docs, area).collect()
    assert all(1 <= r["copy"] <= r["copies"] for r in found)
    assert {r["source"] for r in found} <= {None, "s"}
    weights = spark.createDataFrame([(None, 1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.replicate(docs, StagingArea(spark), weights).collect()} <= {None}
    assert mixing.replicate(none, StagingArea(spark)).count() == 0


def test_fingerprints(docs, none):
    found = fingerprint.fingerprints(docs).collect()
    assert len(found) == len(ODD)
    by = {r["doc_id"]: r for r in found}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[3]["fingerprint"]
    assert by[1]["near_edited"] == 1.0 and by[1]["n_chars"] == 0 and by[4]["n_chars"] == len(LONG)
    assert fingerprint.fingerprints(none).count() == 0
    assert fingerprint.fingerprints(docs.filter("doc_id = 9")).first()["near_next"] == 1.0


def test_token_files(docs, none, area, spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    found = sorted(token_files.round_trip(docs, path, area).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in found]
    assert ids[0] is None and ids[1:] == sorted(i for i, _ in ODD if i is not None)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:]))
    assert {r["doc_id"]: r["n_tokens"] for r in found}[1] == 1
    assert token_files.round_trip(none, path, StagingArea(spark)).count() == 0


def test_embeddings(spark, area):
    vectors = [
        (1, [1.0, 0.0, 0.0]),
        (2, [1.0, 0.0, 0.0]),
        (3, [10.0, 0.5, 0.0]),
        (4, None),
        (5, [0.0, 0.0, 0.0]),
        (6, [float("nan"), 1.0, 0.0]),
        (7, [float("inf"), 1.0, 0.0]),
        (8, [1.0, None, 0.0]),
        (9, []),
        (10, [1.0, 0.0]),
        (None, [1.0, 0.0, 0.0]),
        (2, [1.0, 0.0, 0.0]),
        (12, [1e-300, 0.0, 0.0]),
    ]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], "vec_id long, embedding array<double>, rep string, n string")
    found = embedding_dedup.deduplicate(table, area).collect()
    assert len(found) == len(vectors)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert by[1] == (4, 1, True) and by[2] == (4, 1, False) and by[3] == (4, 1, False) and by[12] == (4, 1, False)
    assert all(by[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)) and by[None] == (0, None, False)
    assert embedding_dedup.deduplicate(table.limit(0), StagingArea(spark)).count() == 0
