"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import collections
import hashlib
import math
import pathlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codetide.llm import mixing, packing, quality
from codetide.session import StagingArea
from tests.llm.test_methods import components_of, sets_of

DATA = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that go into each stage, and what the last returns."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for number, (name, work) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        work(spark, docs, str(DATA)).write.parquet(f"{root}/{number}")
        docs = spark.read.parquet(f"{root}/{number}")
    return [[r.asDict() for r in d.collect()] for d in (*out, docs)]


def test_columns_and_languages(spark, stages):
    for rows in stages[1:5]:
        assert list(rows[0]) == ["doc_id", "text", "lang", "source", "n_chars"]
    # the given documents are all of a learned language, but for those without letters
    kept = {r["doc_id"] for r in stages[1]}
    assert kept == {r["doc_id"] for r in stages[0] if any(c.isalpha() for c in r["text"])}


def test_strange_texts_go(spark):
    """Scripts and languages that were not learned and letters at random go; clean texts stay, short ones too."""
    some = random.Random(5)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first = docs.orderBy("doc_id").limit(1).collect()[0]
    noise = ["".join(some.choices("abcdefghijklmnopqrstuvwxyz", k=some.randint(2, 9))) for _ in range(120)]
    strange = {
        10**9: "Это предложение написано на русском языке, и оно достаточно длинное. " * 4,
        10**9 + 1: "これは日本語で書かれた文章です。この文章は十分に長いです。" * 4,
        10**9 + 2: " ".join(noise),
        10**9 + 3: "zxqv kjwx qqz vkx zzj " * 30,
        10**9 + 4: "1234 5678 !!",
        10**9 + 5: None,
    }
    words = first["text"].split()
    clean = {2 * 10**9: words[3], 2 * 10**9 + 1: " ".join(words[:4]), 2 * 10**9 + 2: " ".join(words[5:60])}
    # ids in the held-out fold teach nothing
    planted = spark.createDataFrame([(i, t, None, "s", 1) for i, t in {**strange, **clean}.items()], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.by_language(spark, docs.unionByName(planted), str(DATA)).collect()}
    assert kept & set(strange) == set() and set(clean) <= kept
    assert len(kept) == len(clean) + sum(any(c.isalpha() for c in r["text"]) for r in docs.collect())
    assert corpus_pipeline.by_language(spark, docs.limit(0), str(DATA)).count() == 0


def test_quality(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in stages[1]}
    taught = {d: q for d, q in labels.items() if d in texts and zlib.crc32(str(d).encode()) % 4 != 2}
    rows = [(d, q) for d, q in taught.items()]
    counts, totals = {0: collections.Counter(), 1: collections.Counter()}, collections.Counter()
    for d, q in rows:
        counts[q].update(quality.features(texts[d]).tolist())
    size = 1 << quality.BITS
    total = {q: sum(counts[q].values()) + size for q in (0, 1)}
    ratio = {j: math.log((counts[1][j] + 1) / total[1]) - math.log((counts[0][j] + 1) / total[0]) for q in (0, 1) for j in counts[q]}
    model = quality.learn(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string"),
        spark.createDataFrame(rows, "doc_id long, label int"),
        StagingArea(spark),
    )
    # where no training text has an n-gram, its weight is nothing
    assert {j for j in range(size) if model.weight[j]} <= set(ratio)
    margin = lambda t: sum(model.weight[j] for j in set(quality.features(t).tolist())) / math.sqrt(max(1, len(quality.features(t)))) + model.intercept
    score = {d: 1 / (1 + math.exp(-(model.slope * margin(t) + model.offset))) for d, t in texts.items()}
    assert {r["doc_id"] for r in stages[2]} == {d for d, s in score.items() if s >= 0.7}


def test_one_of_each_group(stages):
    rows = sorted(stages[2], key=lambda r: r["doc_id"])
    roots = components_of(sets_of([r["text"] for r in rows]))
    assert sorted(r["doc_id"] for r in stages[3]) == [rows[i]["doc_id"] for i, root in enumerate(roots) if i == root]


def test_copies(stages):
    chars = collections.Counter()
    for r in stages[3]:
        chars[r["source"]] += len(r["text"]) + 1
    want = collections.Counter()
    for r in stages[3]:
        rate = sum(chars.values()) / len(chars) / chars[r["source"]]
        parts, copies = max(1, math.ceil(rate / mixing.PART)), 0
        for part in range(1, parts + 1):
            digest = hashlib.md5(f"{mixing.SEED}|{r['doc_id']}|{part}".encode()).hexdigest()
            u, mean = int(digest[:13], 16) / 2**52, rate / parts
            mass = total = math.exp(-mean)
            while total <= u:
                copies += 1
                mass *= mean / copies
                total += mass
        want[r["doc_id"]] = copies
    assert collections.Counter(r["doc_id"] for r in stages[4]) == +want


def test_batches(stages):
    rows = stages[5]
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(r["doc_id"] for r in stages[4])
    batches = collections.defaultdict(list)
    for r in rows:
        assert r["n_tokens"] == len([w for w in r["text"].split() if w]) + 1
        batches[r["batch"]].append(r)
    for held in batches.values():
        assert len({r["width"] for r in held}) == 1 and sorted(r["slot"] for r in held) == list(range(len(held)))
        assert len(held) == 1 or len(held) * held[0]["width"] <= packing.TOKEN_BUDGET


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, str(DATA)).agg(F.count("*"), F.sum("n_tokens")).first()
    assert tuple(rows) == (len(stages[5]), sum(r["n_tokens"] for r in stages[5]))
