"""The methods against brute force, exact round trips and held-out accuracy."""

import collections
import itertools
import pathlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from codetide.llm import embedding_dedup, fingerprint, lattice, ngram_join, packing, quality, sharding, token_files
from codetide.llm.components import components
from codetide.llm.queries import ORACLES, QUERIES
from codetide.session import StagingArea

DATA = pathlib.Path("/root/testdata/sf0.001")
given_data = pytest.mark.skipif(not DATA.exists(), reason="the given tables are not here")


@given_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    from tools.check_oracles import connect

    got = QUERIES[name](spark, str(DATA)).toArrow()
    want = connect(str(DATA)).execute(ORACLES[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    count = lambda t: collections.Counter(zip(*[t[c].to_pylist() for c in columns]))
    assert count(got) == count(want)


@given_data
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = QUERIES["op4_language"](spark, str(DATA)).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * n
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = QUERIES["op2_quality"](spark, str(DATA)).filter("held_out").join(labels, "doc_id")
    right, n = found.agg(F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert right >= 0.85 * n


def test_descent_separates_and_calibration_is_monotone():
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 50, 12) + (100 if i % 2 else 0)).astype(np.int32) for i in range(60)]
    signs = np.where(np.arange(60) % 2, 1.0, -1.0)
    ratio = np.where(np.arange(200) >= 100, 1.0, -1.0)
    weight, intercept = quality.descend(rows, signs, ratio)
    margin = quality.margins(rows, weight * ratio, intercept)
    assert (np.sign(margin) == signs).all()
    slope, _ = quality.calibrate(margin, signs > 0)
    assert slope > 0


@pytest.mark.parametrize("seed", range(3))
def test_shards_have_the_smallest_capacity(spark, seed):
    draw = random.Random(seed)
    texts = ["x" * draw.choice([0, 1, 5, 20, 300]) + str(draw.randrange(20)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sharding.shard(docs, 6, StagingArea(spark)).collect()
    loads = collections.Counter()
    for r in found:
        loads[r["shard"]] += r["size"]
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    homes = collections.defaultdict(set)
    for r in found:
        homes[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    sizes = [len(t.encode()) * c + 8 * c for t, c in collections.Counter(texts).items()]  # in order of first id
    fits = lambda c: max(sizes) <= c and 6 >= 1 + sum(1 for _ in _cuts(sizes, c))
    assert max(loads.values()) == next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


def _cuts(sizes, capacity):
    held = 0
    for s in sizes:
        if held + s > capacity:
            yield held
            held = 0
        held += s


def test_hidden_ends_are_refined(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GRID_BITS", 3)
    draw = random.Random(5)
    sizes = [draw.randrange(8, 400) for _ in range(300)]
    ends = list(itertools.accumulate(sizes))
    groups = spark.createDataFrame(list(zip(ends, sizes)), "end long, bytes long")
    cuts = sharding.cut(groups, 7)
    loads = np.diff([0, *cuts, ends[-1]])
    assert set(cuts) <= set(ends)
    best = next(c for c in range(max(sizes), sum(sizes)) if 1 + sum(1 for _ in _cuts(sizes, c)) <= 7)
    assert loads.max() == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 9)), min_size=1, max_size=8, unique_by=lambda x: x[0]), st.integers(1, 4))
def test_buckets_pad_least(cells, buckets):
    cells = sorted(cells)
    length, n = np.array([c for c, _ in cells]), np.array([k for _, k in cells])
    cost = lambda ends: sum((length[e] - length[i]) * n[i] for b, e in zip([-1, *ends], ends) for i in range(b + 1, e + 1))
    got = packing.boundaries(length, n, length * n, buckets)
    last = len(cells) - 1
    every = [list(c) + [last] for k in range(min(buckets, len(cells))) for c in itertools.combinations(range(last), k)]
    assert got[-1] == last and len(got) <= buckets and cost(got) == min(map(cost, every))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=700), st.integers(0, 32))
def test_blocks_round_trip(values, bits):
    ids = np.array([v >> (32 - bits) if i % 9 else v for i, v in enumerate(values)], np.uint32)
    file = token_files.TokenFile.parse(token_files.file_bytes([None, 5], np.array([0, len(ids)]), ids))
    assert (file.ids() == ids).all() and file.docs == [None, 5]
    for i in range(len(file.starts) - 1):
        assert (file.block(i) == ids[i * token_files.BLOCK : (i + 1) * token_files.BLOCK]).all()


@given_data
def test_token_files_hold_the_tokenizers_ids(spark, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_files, "CACHE", 500)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in QUERIES["op10_token_files"](spark, str(DATA)).collect()}
    encoder, at = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json")), 0
    for row in docs:
        ids = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        got = found[row["doc_id"]]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        assert encoder.encode(row["text"] or "") == ids[:-1].tobytes()
        at += len(ids)
    signs = "aZq'stmdrevl09!<|>.-_ \t\u00df\u00c9\u00e9\u00f7\u00d7\u00ff\u00c0\u03a3\u0301\u00aa\u00a0"
    draw = random.Random(4)
    for _ in range(3000):
        odd = "".join(draw.choice(signs) for _ in range(draw.randrange(12)))
        assert np.frombuffer(encoder.encode(odd), "<u4").tolist() == tokenizer.encode(odd, add_special_tokens=False).ids, repr(odd)
    for odd in ("á b", "Σας ΣΑΣ", "<|endoftext|> x<|startoftext|>y", "a\x1cb\x0bc d e", "It's we'll 3.4", "İx e\ńx"):
        assert np.frombuffer(encoder.encode(odd), "<u4").tolist() == tokenizer.encode(odd, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=300), st.lists(st.integers(0, 500), max_size=300))
def test_peeling_recovers_all_differences(a, b):
    name = lambda xs: np.unique(fingerprint._mix(np.array(xs, np.uint64)))
    left, right = name(a), name(b)
    assert fingerprint.differences([left, right], [right, right]).tolist() == [len(set(left.tolist()) ^ set(right.tolist())), 0]
    big = fingerprint.Sketches(1, 6000)
    big.add(np.zeros(len(left), np.int64), left)
    big.add(np.zeros(len(right), np.int64), right, -1)
    _, keys, done = big.peel()
    assert done.all() and set(keys.tolist()) == set(left.tolist()) ^ set(right.tolist())


@given_data
def test_fingerprints_against_brute_force(spark):
    import hashlib

    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in QUERIES["op9_fingerprint"](spark, str(DATA)).collect()}
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    pieces = lambda t: set(fingerprint.digests(t).tolist())
    for row, following in zip(docs, docs[1:] + docs[:1]):
        text, got = row["text"], found[row["doc_id"]]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following["text"][:quarter]
        assert got["n_chars"] == len(text)
        assert got["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert got["near_edited"] == pytest.approx(alike(pieces(text), pieces(changed)))
        assert got["near_next"] == pytest.approx(alike(pieces(text), pieces(following["text"])))


def test_nearest_lattice_points():
    x = np.random.default_rng(3).normal(size=(50, 8)) * 2
    got = lattice.nearest(x)
    whole = np.isclose(got, np.rint(got)).all(axis=1)
    assert (whole | np.isclose(got - 0.5, np.rint(got - 0.5)).all(axis=1)).all()
    assert (np.rint(got.sum(axis=1)) % 2 == 0).all()
    near = ((x[:, None, :] - got[:, None, :] - lattice.roots()[None]) ** 2).sum(axis=2)
    assert (((x - got) ** 2).sum(axis=1) <= near.min(axis=1) + 1e-9).all()
    assert len(np.unique(lattice.hashed(lattice.roots(), 0))) == 240


def test_recall_of_links(spark, monkeypatch):
    """Pairs spread over all cosines from 0.9 up, and a crowd that fills whole cells."""
    monkeypatch.setattr(embedding_dedup, "CELL_BLOCK", 16)
    draw = np.random.default_rng(5)
    base = embedding_dedup.unit(draw.normal(size=(300, 64)))
    other = draw.normal(size=base.shape)
    other = embedding_dedup.unit(other - (other * base).sum(axis=1, keepdims=True) * base)
    cosine = draw.uniform(0.85, 1.0, (300, 1))
    crowd = base[:1] + draw.normal(size=(120, 64)) * 0.02
    vectors = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * other, crowd]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = {r["vec_id"]: r for r in embedding_dedup.deduplicate(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), StagingArea(spark)).collect()}
    units = embedding_dedup.unit(vectors)
    want = (units @ units.T >= 0.9).sum(axis=1) - 1
    got = np.array([found[i]["n_links"] for i in range(len(rows))])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()


def near_groups(seed, n=120):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(draw.randrange(1, 5)))
    shared = " ".join(word() for _ in range(25))
    texts = []
    for _ in range(n):
        kind = draw.randrange(4)
        if kind == 0 or not texts:
            texts.append(" ".join(word() for _ in range(draw.randrange(0, 60))))
        elif kind == 1:
            texts.append(shared + " " + " ".join(word() for _ in range(draw.randrange(3, 40))))
        else:
            words = draw.choice(texts).split()
            for _ in range(draw.randrange(0, 3)):
                if words:
                    words[draw.randrange(len(words))] = word()
            texts.append(" ".join(words).title() if draw.random() < 0.2 else " ".join(words))
    return texts


def sets_of(texts):
    out = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        out.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    return out


def components_of(sets):
    root = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
            a, b = root[i], root[j]
            if a != b:
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("seed", range(2))
def test_ngram_join_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)  # so that some n-grams are frequent here
    texts = near_groups(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in ngram_join.join(docs, StagingArea(spark)).collect()}
    sets = sets_of(texts)
    assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i]["component_id"] for i in range(len(texts))] == components_of(sets)


@pytest.mark.parametrize("dense", [2, 16])
def test_ngram_join_counts_all_links(spark, dense, monkeypatch):
    monkeypatch.setattr(ngram_join, "DENSE_CELLS", 700)
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 8)  # so that groups need several blocks
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 1000)
    draw, base = random.Random(5), [f"w{k}" for k in range(80)]
    texts = near_groups(7, 60) + ["", None]
    for _ in range(60):  # a group that links only in part, of several sizes, with equal texts
        words = base[: draw.randrange(60, 81)]
        words[draw.randrange(len(words))] = draw.choice("xyz")
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in ngram_join.join(docs, StagingArea(spark)).collect()}
    sets = sets_of([t or "" for t in texts])
    similar = lambda a, b: len(a & b) > 0 and 100 * len(a & b) >= 80 * len(a | b)
    assert [found[i]["n_links"] for i in range(len(texts))] == [
        sum(similar(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)
    ]
    assert [found[i]["component_id"] for i in range(len(texts))] == components_of(sets)
    assert "n_links" not in ngram_join.join(docs, StagingArea(spark), count_links=False).columns


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)]
    roots, area = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in roots.collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    area.release()


def test_block_links_are_summed_over_fragments():
    """A group's links are told from blocks and fragments; pairs of it are never rows."""
    texts = [t for t in near_groups(3, 60) if t]
    grams = {ngram_join.class_of(g): g for g in ngram_join.ngrams(texts)}
    names = sorted(grams)
    segments = ngram_join._segments(np.sort(np.unique(np.concatenate(list(grams.values())))[::7]))([], [grams[c] for c in names])
    rows = pd.DataFrame(segments).assign(i=0, j=1, size=1)
    rows["n"] = [len(grams[c]) for c in rows["class"]]
    similar = lambda a, b: a != b and 180 * len(np.intersect1d(grams[a], grams[b])) >= 80 * (len(grams[a]) + len(grams[b]))
    for j, left in ((0, names), (1, names[:20])):
        rows["j"], rows["right"] = j, ~rows["class"].isin(left)
        partial = pd.concat([ngram_join._partial(part) for _, part in rows.groupby("fragment")])
        found = ngram_join._block_links(partial)
        others = lambda c: names if j == 0 else [x for x in names if (x in left) != (c in left)]
        assert dict(zip(found["class"], found["linked"])) == {c: sum(similar(c, x) for x in others(c)) for c in names}
        assert found["linked"].sum() and all(near == c for c, n, near in found.itertuples(index=False) if not n)
