"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is one pass in which each task adds up the n-grams of its training texts per language;
only (language, bucket, count) rows are shuffled, so a language with a third of all rows is summed
where it lies.  The log-probability matrix that goes to the scoring tasks has at most
``MATRIX_CELLS`` entries: with many languages there are fewer hash buckets, never fewer languages.
Scoring turns a batch of texts into one sparse count matrix and multiplies it with the dense one.

The posterior says which language fits best, not whether any does: over a whole text it runs to 1.
``Spread`` holds that against the training texts: what their n-grams' mean log-probability is in their
own language, and how far it strays from text to text and from n-gram to n-gram.  ``recognise`` calls a text strange
whose mean lies ``STRANGE`` such deviations below; a short one has too few n-grams to be strange.

Defined results: a text that is null or holds no letter is ``und`` with score 0; so is every text
when nothing could be learned; neither is recognised.  Rows with a null language, a null text or a null id teach nothing.
Columns beside id, text and language are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "und"
SIZES = (1, 2, 3)
MATRIX_CELLS = 1 << 22
MAX_BITS = 16
# wide odd multipliers of a polynomial hash
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
SPACE = 32
FLUSH_LANGUAGES = 64
# deviations below the training texts that make a text strange; n-grams that overlap count for one
STRANGE = 15.0
OVERLAP = 3.0

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text: str | None, bits: int) -> np.ndarray:
    """Bucket of every character n-gram of the text; empty if it has no letter.

    Letters count in lower case, all between two letters as one space, and words begin and end
    with one, so that n-grams see word ends.
    """
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.empty(0, np.int64)
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]  # the first non-letter after a word stands for the gap
    codes = np.where(is_letter, points, SPACE)[kept].astype(np.uint64)
    codes = np.concatenate(([np.uint64(SPACE)], codes, [np.uint64(SPACE)]))
    found, rolling = [], np.zeros(len(codes), np.uint64)
    for size in SIZES:
        n = len(codes) - size + 1
        if n < 1:
            break
        rolling = rolling[:n] * STEP + codes[size - 1 :] + np.uint64(size)
        found.append((rolling * SPREAD) >> np.uint64(64 - bits))
    return np.concatenate(found).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Learned languages in order, and for each bucket a row of log-probabilities."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray
    bits: int


def _tally(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for language, per_bucket in counts.items():
                hit = np.flatnonzero(per_bucket)
                yield pd.DataFrame({"language": language, "bucket": hit, "n": per_bucket[hit]})
            counts.clear()

        for batch in batches:
            for language, text in zip(batch["language"], batch["text"]):
                if language not in counts:
                    if len(counts) >= FLUSH_LANGUAGES:
                        yield from rows()
                    counts[language] = np.zeros(1 << bits, np.int64)
                counts[language] += np.bincount(grams(text, bits), minlength=1 << bits)
        yield from rows()

    return run


def learn(examples: DataFrame, smoothing: float = 0.1) -> Model:
    """Fit on all rows of ``examples`` (text, language), none of them null."""
    per_language = sorted(tuple(r) for r in examples.groupBy("language").count().collect())
    languages = [name for name, _ in per_language]
    bits = MAX_BITS
    while bits > 6 and len(languages) << bits > MATRIX_CELLS:
        bits -= 1
    if len(languages) << bits > MATRIX_CELLS:
        raise ValueError(f"{len(languages)} languages are more than this model is for")
    counts = np.zeros((1 << bits, len(languages)))
    if languages:
        tallied = examples.mapInPandas(_tally(bits), "language string, bucket long, n long")
        summed = tallied.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
        column = {name: i for i, name in enumerate(languages)}
        counts[summed["bucket"], summed["language"].map(column)] = summed["n"]
    prob = (counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts))
    documents = np.array([n for _, n in per_language], float)
    return Model(languages, np.log(documents / documents.sum()) if languages else documents, np.log(prob), bits)


def score_batch(texts, model: Model) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior probability for each text."""
    best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows, buckets, counts = [], [], []
    for i, text in enumerate(texts):
        found = grams(text, model.bits)
        if len(found) and model.languages:
            tally = np.bincount(found, minlength=1 << model.bits)
            hit = np.flatnonzero(tally)
            rows.append(i)
            buckets.append(hit)
            counts.append(tally[hit])
    if not rows:
        return best, score
    starts = np.cumsum([0] + [len(b) for b in buckets[:-1]])
    log_prob = model.log_prob.shape[1]
    weighted = np.empty((len(rows), log_prob))
    at, values = np.concatenate(buckets), np.concatenate(counts)
    for k in range(log_prob):
        weighted[:, k] = np.add.reduceat(values * model.log_prob[at, k], starts)
    weighted += model.log_prior
    top = weighted.argmax(axis=1)
    share = 1 / np.exp(weighted - weighted.max(axis=1, keepdims=True)).sum(axis=1)
    for i, k, s in zip(rows, top, share):
        best[i], score[i] = model.languages[k], s
    return best, score


def predict(model: Model, text: str = "text") -> Column:
    """A struct (lang_pred, score) for each text."""
    block = 256  # texts whose sparse rows are held at once

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        best, score = [], []
        for at in range(0, len(texts), block):
            b, s = score_batch(list(texts.iloc[at : at + block]), model)
            best += b
            score.append(s)
        return pd.DataFrame({"lang_pred": best, "score": np.concatenate(score) if score else np.empty(0)})

    return scored(F.col(text))


@dataclass(frozen=True)
class Spread:
    """Per language of a model: mean log-probability of the training texts, its variance between texts and between n-grams."""

    mean: np.ndarray
    between: np.ndarray
    within: np.ndarray

    def strange(self, fit: np.ndarray, size: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Whether texts of ``size`` n-grams with mean log-probability ``fit`` are unlike their language."""
        deviation = np.sqrt(self.between[language] + OVERLAP * self.within[language] / np.maximum(size, 1))
        return fit < self.mean[language] - STRANGE * deviation


def _fit(text: str | None, model: Model, language: int) -> tuple[int, float, float]:
    """Number of n-grams, and sum and sum of squares of their log-probabilities in a language."""
    found = model.log_prob[grams(text, model.bits), language]
    return len(found), float(found.sum()), float((found**2).sum())


def spread(examples: DataFrame, model: Model) -> Spread:
    """How well the training texts (text, language) fit their own language; one row of sums per task and language."""
    place = {name: i for i, name in enumerate(model.languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(place), 6))
        for batch in batches:
            for language, text in zip(batch["language"], batch["text"]):
                size, total, squares = _fit(text, model, place[language])
                if size:
                    mean = total / size
                    sums[place[language]] += (1, mean, mean * mean, size, total, squares)
        yield pd.DataFrame(sums, columns=list("abcdef")).assign(language=range(len(place)))

    whole = np.zeros((len(place), 6))
    if place:
        added = examples.mapInPandas(run, "language int, a double, b double, c double, d double, e double, f double")
        for r in added.groupBy("language").agg(*[F.sum(c).alias(c) for c in "abcdef"]).collect():
            whole[r["language"]] = [r[c] for c in "abcdef"]
    texts, grams_ = np.maximum(whole[:, 0], 1), np.maximum(whole[:, 3], 1)
    mean, inner = whole[:, 1] / texts, whole[:, 4] / grams_
    return Spread(mean, np.maximum(whole[:, 2] / texts - mean**2, 0), np.maximum(whole[:, 5] / grams_ - inner**2, 0))


def recognise(model: Model, known: Spread, text: str = "text") -> Column:
    """Whether a text is of a learned language, and like the texts it was learned from."""

    @F.pandas_udf("boolean")
    def judged(texts: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(texts), 256):
            some = list(texts.iloc[at : at + 256])
            best, _ = score_batch(some, model)
            for one, name in zip(some, best):
                if name == UNKNOWN:
                    out.append(False)
                    continue
                language = model.languages.index(name)
                size, total, _ = _fit(one, model, language)
                out.append(not known.strange(np.array(total / size), np.array(size), np.array(language)))
        return pd.Series(out, dtype=bool)

    return judged(F.col(text))


def identify(docs: DataFrame, held_out: Column, learn_from: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``learn_from`` says which rows may teach; only their text and lang are used.
    """
    examples = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = learn(examples.select("text", F.col("lang").alias("language")))
    found = docs.select("doc_id", held_out.alias("held_out"), predict(model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
