"""Mined negatives against all scores; the tree against its definition."""

from collections import Counter

import numpy as np
import pytest

from codetide.llm import hard_negatives
from codetide.session import StagingArea

SCHEMA = "vec_id long, label long, vector array<long>, anchor boolean, row string, score string"


@pytest.fixture
def area(spark):
    made = StagingArea(spark)
    yield made
    made.release()


def brute(rows):
    """(anchor_id, positive_id, rank, negative_id, positive score, negative score) by all scores."""
    rows = [(n, *r) for n, r in enumerate(rows) if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2] and sum(x * x for x in r[2]) <= 1 << 62]
    out = []
    for n, i, label, v, asks in rows:
        if not asks:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, m, other == label) for m, j, other, w, _ in rows if m != n and len(w) == len(v)]
        scored.sort(key=lambda s: s[:3])
        for good in [s for s in scored if s[3]][:5]:
            close = [s for s in scored if not s[3] and 80 * -good[0] <= 100 * -s[0] <= 100 * -good[0]]
            out += [(i, good[1], rank, bad[1], -good[0], -bad[0]) for rank, bad in enumerate(close[:5], 1)]
    return Counter(out)


def found(spark, rows, area, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r[n] for n in names) for r in hard_negatives.mine(df, area, **more).collect())


def vectors(count, size, seed, spread=60):
    make = np.random.default_rng(seed)
    centres = make.normal(0, 120, (6, size))
    labels = make.integers(0, 5, count)
    near = centres[make.integers(0, 6, count)] + make.normal(0, spread, (count, size))
    return [(n, int(labels[n]), [int(x) for x in np.floor(near[n])], n % 9 == 0) for n in range(count)]


@pytest.mark.parametrize(("size", "spread"), [(3, 60), (24, 15), (24, 200)])
def test_equals_all_scores(spark, area, size, spread):
    rows = vectors(300, size, size + spread, spread)
    assert found(spark, rows, area) == brute(rows)


def test_blocks_of_anchors_and_small_tiles(spark, area, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    rows = vectors(260, 8, 5, 40)
    assert found(spark, rows, area) == brute(rows)


ODD = [
    (None, 1, [1, 2], True), (1, None, [1, 2], True), (2, 1, None, True), (3, 1, [1, None], True),
    (4, 1, [3, 4], True), (4, 1, [3, 4], True), (4, 2, [3, 4], False), (5, 1, [4, 3], False), (6, 1, [3, 4], False), (7, 2, [3, 4], False), (8, 2, [3, 4], False),
    (9, 1, [], True), (10, 1, [], False), (11, 2, [], False), (12, 1, [0, 0], True), (13, 2, [0, 0], False), (14, 3, [-3, -4], True), (15, 3, [3, 4], False),
    (16, 4, [1, 1, 1], True), (17, 5, [1, 1, 1], False), (-100, 6, [1 << 29, 1 << 28], True), (19, 6, [(1 << 29) - 1, 1 << 28], False), (20, 7, [(1 << 29) - 3, 1 << 28], False),
    (21, 6, [1 << 40, 1], True), (22, 1, [3, 4], None),
]


def test_odd_rows(spark, area):
    assert found(spark, ODD, area) == brute(ODD)
    assert brute(ODD)[-100, 19, 1, 20, (1 << 58) - (1 << 29) + (1 << 56), (1 << 58) - 3 * (1 << 29) + (1 << 56)] == 1


def test_empty_and_without_anchors(spark, area):
    assert not found(spark, [], area) and not found(spark, [(1, 1, [1], False)], StagingArea(spark))


def test_tree_joins_every_anchor_to_its_nearest_earlier_one():
    points = np.random.default_rng(4).integers(-50, 50, (40, 3))
    tree = hard_negatives.Tree(np.arange(40), list(range(40)), points)
    assert sorted(tree.rows.tolist()) == list(range(40)) and tree.parents[0] == -1
    apart = lambda a, b: float(np.sqrt(((a - b) ** 2).sum()))
    for n in range(1, 40):
        assert tree.parents[n] < n and tree.reach[n] == pytest.approx(apart(tree.vectors[n], tree.vectors[tree.parents[n]]))
        # no other anchor not yet in the tree is nearer to it
        assert tree.reach[n] == pytest.approx(min(apart(tree.vectors[m], tree.vectors[p]) for m in range(n, 40) for p in range(n)))


def test_bounds_leave_scores_out():
    """On close anchors, far rows are not scored again: the scan must not read them."""
    rows = np.array([[1000, 0], [1001, 1], [999, -1]])
    tree = hard_negatives.Tree(np.arange(3), [0, 0, 0], rows)
    best = hard_negatives.Best(-np.inf, np.inf, 2)
    best.take(np.array([10, 9, 8, 9]), np.array([1, 5, 2, 3]), np.arange(4))
    assert best.score.tolist() == [10, 9] and best.vec_id.tolist() == [1, 3] and best.least == 9
    assert max(tree.reach) < 2
