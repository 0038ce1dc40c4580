"""Quality classifier: linear support vectors on n-gram indicators scaled by naive-Bayes ratios.

One pass over the labelled training texts adds up, per class and hashed n-gram, how many texts hold
it (all of them count), and hands on the features of a bounded sample for the linear fit.  The
sample is the ``SAMPLE`` rows with the smallest hash of their id.  The fit, dual coordinate descent
on the hinge loss, runs in one task over that sample; so does the calibration, a logistic curve
through the margins that held-out thirds of the sample get.  What goes to the scoring tasks is one
weight per hash bucket, whatever the size of the corpus.

An n-gram is of characters (1 to 3, as UTF-8 bytes), of words (single), or of word shapes (1 to 4).
A word's shape says how it is written (upper, lower, capitalised, digits, signs) and whether it is
new in the text, was seen before, or repeats the word in front of it.

Defined results: null and empty texts have no n-gram and get the score of the bare intercept; with no
training rows, or a single class among them, all texts get the same score from the class counts.
Several labels for one id count once, as their smallest value.  Null labels and ids teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from codetide.session import stage

BITS = 17
SAMPLE = 8000
EPOCHS = 12
CUT = 0.7
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)

UPPER, LOWER, DIGIT, SPACE, SIGN = 1, 2, 4, 8, 16
_KIND = np.full(256, LOWER, np.uint8)  # bytes of longer characters count as small letters
for _b in range(128):
    _c = chr(_b)
    _KIND[_b] = UPPER if _c.isupper() else LOWER if _c.islower() else DIGIT if _c.isdigit() else SPACE if _c.isspace() else SIGN


def _bucket(values: np.ndarray, salt: int) -> np.ndarray:
    return ((values + np.uint64(salt)) * SPREAD >> np.uint64(64 - BITS)).astype(np.int32)


def _runs(codes: np.ndarray, sizes: range, salt: int) -> Iterator[np.ndarray]:
    rolling = np.zeros(len(codes), np.uint64)
    for size in sizes:
        n = len(codes) - size + 1
        if n < 1:
            return
        rolling = rolling[:n] * STEP + codes[size - 1 :] + np.uint64(1)
        yield _bucket(rolling, salt + size)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the n-grams of a text."""
    if not text:
        return np.empty(0, np.int32)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    found = list(_runs(data.astype(np.uint64), range(1, 4), 0))
    kind = _KIND[data]
    solid = kind != SPACE
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts):
        place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(data)]))))
        power = np.multiply.accumulate(np.full(int((ends - starts).max()) + 1, STEP))
        weighed = np.where(solid, (data.astype(np.uint64) + np.uint64(1)) * power[np.minimum(place, len(power) - 1)], np.uint64(0))
        words = np.add.reduceat(weighed, starts)
        has = np.bitwise_or.reduceat(np.where(solid, kind, 0), starts)
        first = kind[starts]
        _, first_at, same = np.unique(words, return_index=True, return_inverse=True)
        seen = (first_at[same] != np.arange(len(words))).astype(np.uint64)
        seen[1:] += words[1:] == words[:-1]
        shape = has.astype(np.uint64) * np.uint64(2) + (first == UPPER)
        found.append(_bucket(words, 16))
        found += _runs(shape * np.uint64(3) + seen, range(1, 5), 32)
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """Weight per bucket (ratio and support-vector weight in one), intercept, logistic curve."""

    weight: np.ndarray
    intercept: float
    slope: float
    offset: float


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = 1.0, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; labels are -1 and 1.

    A row's value in bucket j is ratio[j] / sqrt(number of its buckets); the intercept is a
    feature of value 1.
    """
    weight, intercept = np.zeros(len(ratio)), 0.0
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    squared = np.array([v @ v + 1.0 for v in values])
    dual = np.zeros(len(rows))
    turn = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in turn.permutation(len(rows)):
            r, v, y = rows[i], values[i], labels[i]
            slack = y * (weight[r] @ v + intercept) - 1.0
            new = min(max(dual[i] - slack / squared[i], 0.0), cost)
            change = (new - dual[i]) * y
            if change:
                weight[r] += change * v
                intercept += change
                dual[i] = new
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return weight, intercept


def margins(rows: list[np.ndarray], weight: np.ndarray, intercept: float) -> np.ndarray:
    """``weight`` already holds the ratio."""
    return np.array([weight[r].sum() / np.sqrt(max(len(r), 1)) + intercept for r in rows])


def calibrate(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton's method.

    Targets are drawn in from 0 and 1 by the class counts, so separable data stay finite.
    """
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([margin, np.ones_like(margin)], axis=1)
    at = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    loss = lambda p: np.logaddexp(0, design @ p).sum() - target @ (design @ p) + 1e-6 * p @ p
    for _ in range(50):
        prob = 1 / (1 + np.exp(-np.clip(design @ at, -500, 500)))
        gradient = design.T @ (prob - target) + 2e-6 * at
        hessian = (design * (prob * (1 - prob))[:, None]).T @ design + 2e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (label, bucket, n) per task, and features of the sampled texts."""
    counts = {0: np.zeros(1 << BITS, np.int64), 1: np.zeros(1 << BITS, np.int64)}
    texts = {0: 0, 1: 0}
    for batch in batches:
        ids, kinds, held = [], [], []
        for doc, text, label, sampled in zip(batch["doc_id"], batch["text"], batch["label"], batch["sampled"]):
            found = features(text)
            counts[label][found] += 1
            texts[label] += 1
            if sampled:
                ids.append(doc)
                kinds.append(label)
                held.append(found.astype("<i4").tobytes())
        if ids:
            yield pd.DataFrame({"label": kinds, "bucket": None, "n": None, "doc_id": ids, "found": held}).astype({"bucket": "Int64", "n": "Int64"})
    for label, per_bucket in counts.items():
        if texts[label]:
            hit = np.flatnonzero(per_bucket)
            yield pd.DataFrame({"label": label, "bucket": np.append(hit, -1), "n": np.append(per_bucket[hit], texts[label]), "doc_id": None, "found": None}).astype({"doc_id": "Int64"})


def fit(rows: list[np.ndarray], positive: np.ndarray, ratio: np.ndarray) -> Model:
    """The linear fit on the sample, calibrated on margins of thirds left out in turn."""
    signs = np.where(positive, 1.0, -1.0)
    third, margin = np.arange(len(rows)) % 3, np.zeros(len(rows))
    for k in range(3):
        inside = np.flatnonzero(third != k)
        weight, intercept = descend([rows[i] for i in inside], signs[inside], ratio)
        outside = np.flatnonzero(third == k)
        margin[outside] = margins([rows[i] for i in outside], weight * ratio, intercept)
    weight, intercept = descend(rows, signs, ratio)
    return Model(weight * ratio, intercept, *calibrate(margin, positive))


def learn(docs: DataFrame, labels: DataFrame, area, sample: int = SAMPLE, smoothing: float = 1.0) -> Model:
    """Fit on the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label 0 or 1) covers.

    ``sample`` bounds the rows of the linear fit; the ratios come from all rows.
    """
    one = labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    last = one.select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    marked = one.withColumn("sampled", order <= F.lit(last if last is not None else 0))
    # labels grow with the corpus, so they are never broadcast: the same plan at every size
    joined = docs.select("doc_id", "text").join(marked.hint("merge"), "doc_id")
    gathered = stage(joined.mapInPandas(_gather, "label int, bucket long, n long, doc_id long, found binary"), "gathered", area)

    summed = gathered.filter("bucket is not null").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    texts = {0: 0, 1: 0}
    counts = np.zeros((2, 1 << BITS))
    for label in (0, 1):
        own = summed[summed["label"] == label].astype("int64")
        texts[label] = int(own.loc[own["bucket"] < 0, "n"].sum())
        own = own[own["bucket"] >= 0]
        counts[label, own["bucket"]] = own["n"]
    if not texts[0] or not texts[1]:
        share = (texts[1] + 1) / (texts[0] + texts[1] + 2)
        return Model(np.zeros(1 << BITS), 0.0, 1.0, float(np.log(share / (1 - share))))
    share = (counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * counts.shape[1])
    ratio = np.log(share[1] / share[0])

    def train(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["doc_id", "found"])
        model = fit([np.frombuffer(f, "<i4") for f in held["found"]], (held["label"] == 1).to_numpy(), ratio)
        return pd.DataFrame({"weight": [model.weight.tobytes()], "intercept": [model.intercept], "slope": [model.slope], "offset": [model.offset]})

    drawn = gathered.filter("found is not null").select("label", "doc_id", "found").withColumn("all", F.lit(0))
    got = drawn.groupBy("all").applyInPandas(train, "weight binary, intercept double, slope double, offset double").first()
    return Model(np.frombuffer(got["weight"]), got["intercept"], got["slope"], got["offset"])


def predict(model: Model, text: str = "text") -> Column:
    """The score of each text, 0 to 1."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        margin = margins([features(t) for t in texts], model.weight, model.intercept)
        return pd.Series(1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -500, 500))))

    return scored(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, learn_from: Column, area) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 from ``CUT`` up).

    ``learn_from`` is a condition on doc_id for the rows of ``labels`` (doc_id, quality) that may teach.
    """
    taught = labels.filter(learn_from).select("doc_id", F.col("quality").alias("label"))
    model = learn(docs, taught, area)
    scored = docs.select("doc_id", held_out.alias("held_out"), predict(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
