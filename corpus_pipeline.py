"""A training corpus in stages: each takes (spark, docs, sf_dir) and returns the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide.llm import language_id, mixing, ngram_join, packing, quality
from codetide.llm.common import HELD_OUT, bounded, fold, table
from codetide.session import StagingArea, stage


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a learned language that are like its training texts.

    Texts without letters go, and those whose n-grams are far less likely in their best language than the training texts'
    are: other scripts, other languages, letters at random.  Short texts have too few n-grams to be told by them and stay.
    Null texts go; rows of a null or repeated id are judged by their text like others; an empty table stays empty.
    """
    taught = docs.filter((fold() != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    taught = taught.select("text", F.col("lang").alias("language"))
    model = language_id.learn(taught)
    return docs.filter(language_id.recognise(model, language_id.spread(taught, model)))


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier, trained on labelled documents at hand, calls good."""
    columns = docs.columns
    area = _area(spark)
    taught = table(spark, sf_dir, "labels").filter(fold() != HELD_OUT).select("doc_id", F.col("quality").alias("label"))
    model = quality.learn(docs, taught, area)
    return docs.withColumn("__score", quality.predict(model)).filter(F.col("__score") >= quality.CUT).select(*columns)


def by_similarity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    Rows go by id and text, so that a row keeps its place whatever others with its id (or
    without one) hold; exact repeats of a row leave one.
    """
    columns = docs.columns
    area = _area(spark)
    grouped = ngram_join.join(docs, area, count_links=False, keep_text_key=True)
    gone = grouped.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key"))
    gone = bounded(stage(gone.distinct(), "gone", area))
    same = F.col("doc_id").eqNullSafe(F.col("__gone")) & ngram_join.text_key().eqNullSafe(F.col("__key"))
    staying = docs.join(gone, same, "left_anti")
    # only ids that come more than once can have repeats
    repeated = docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("__twice"))
    repeated = bounded(stage(repeated, "repeated", area))
    twice = F.col("doc_id").eqNullSafe(F.col("__twice"))
    once = staying.join(repeated, twice, "left_anti")
    return once.unionByName(staying.join(repeated, twice, "left_semi").dropDuplicates(["doc_id", "text"])).select(*columns)


def by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents until all sources have the same weight, in one shuffled order."""
    columns = docs.columns
    return mixing.replicate(docs, _area(spark)).orderBy(mixing.place(), "doc_id", "copy").select(*columns)


def into_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document copy with its place in a batch of similar lengths."""
    return packing.pack(docs.withColumn("n_tokens", packing.n_tokens()), _area(spark))


STAGES = [
    ("language ID", by_language),
    ("quality classifier", by_quality),
    ("n-gram Jaccard join", by_similarity),
    ("mixing sources to target weights", by_weight),
    ("packing", into_batches),
]

# learned models and an optimal bucket plan decide here; the tests hold run() against a plain version
ORACLE_SQL = None

_HELD: list[StagingArea] = []


def _area(spark: SparkSession) -> StagingArea:
    """A folder for a stage's own tables.  Those of earlier stages go: what they made is written by now."""
    while _HELD:
        earlier = _HELD.pop()
        if earlier.spark is spark:
            earlier.release()
    _HELD.append(StagingArea(spark))
    return _HELD[-1]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    area = StagingArea(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, work) in enumerate(STAGES):
        path = area.path(f"stage{number}")
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
