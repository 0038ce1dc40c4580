"""Mix sources to target weights by Poisson replication.

A source's rate is its share of the wanted characters over the characters it has.  Each document's
number of copies is the Poisson distribution of that rate inverted at a uniform number hashed from
seed and id: no random state, so any task can be repeated.  Documents are exploded by their count and
put in one global order by a hash, dealt by range.

Rates above ``PART`` are split into equal parts whose counts, each inverted at a number of its own,
are added: the distribution stays the same and the table to invert stays short.

Defined results: null is a source of its own.  A document counts one character more than its text has,
so empty and null texts take part.  Rows of equal id get equal counts; a null id hashes like any
other value.  A source without a weight gets none and so no copy.  Columns named like the results
(copy, copies, rate) are replaced by them; others are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from codetide.session import StagingArea, stage

PART = 16
# the chance of more than this many copies in one part is below 2 to the -100
TERMS = 100
SMALL_SOURCES = 10_000
SEED = "mix-1"


def uniform(*parts: Column) -> Column:
    """52 bits of the md5 of the parts, between 0 and 1."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Per source: rate, parts, cdf.  ``weights``: (source, weight); without, all sources weigh the same."""
    sized = docs.select("source", (F.coalesce(F.length("text"), F.lit(0)) + 1).cast("long").alias("chars"))
    per_source = sized.groupBy("source").agg(F.sum("chars").alias("chars"))
    if weights is None:
        weighed = per_source.withColumn("weight", F.lit(1.0))
    else:
        given = weights.select(F.col("source").alias("__source"), "weight")
        weighed = per_source.join(given, F.col("source").eqNullSafe(F.col("__source")), "left").fillna(0.0, ["weight"]).drop("__source")
    all_chars, all_weight = weighed.agg(F.sum("chars"), F.sum("weight")).first()
    wanted = F.lit(float(all_chars or 0)) * F.col("weight") / F.lit(float(all_weight or 1)) / F.col("chars")
    rated = weighed.withColumn("rate", F.when(F.col("weight") > 0, wanted).otherwise(0.0))
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    log_factorial = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(TERMS)])
    rated = rated.withColumn("parts", parts).withColumn("__mean", F.col("rate") / F.col("parts"))
    mass = F.transform(
        F.sequence(F.lit(0), F.lit(TERMS - 1)),
        lambda k: F.exp(k * F.log(F.col("__mean")) - F.col("__mean") - F.get(log_factorial, k)),
    )
    sums = F.transform(
        F.col("__mass"), lambda _, i: F.aggregate(F.slice(F.col("__mass"), 1, i + 1), F.lit(0.0), lambda a, x: a + x)
    )
    return rated.withColumn("__mass", mass).select("source", "rate", "parts", sums.alias("cdf"))


def replicate(docs: DataFrame, area: StagingArea, weights: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """Each document as often as drawn, with copy (from 1), copies and rate."""
    docs = docs.drop(*[c for c in ("copy", "copies", "rate") if c in docs.columns])
    table = stage(rates(docs, weights), "rates", area).withColumnRenamed("source", "__source")
    if table.count() <= SMALL_SOURCES:
        table = F.broadcast(table)
    joined = docs.join(table, F.col("source").eqNullSafe(F.col("__source")))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda total, part: total
        + F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), F.col("doc_id"), part))),
    )
    counted = joined.withColumn("copies", F.when(F.col("rate") > 0, drawn).otherwise(0)).filter("copies > 0")
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("__source", "parts", "cdf")


def place(seed: str = SEED) -> Column:
    """The key of the global order."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy").cast("string")))
