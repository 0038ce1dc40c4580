"""Vectors that share an id are vectors of their own."""

from codetide.llm import embedding_dedup
from codetide.session import StagingArea


def test_one_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.01, 1.0]), (3, [1.0, 0.01]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0]), (0, [0.7, -0.7])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    area = StagingArea(spark)
    found = sorted(tuple(r) for r in embedding_dedup.deduplicate(df, area).collect())
    area.release()
    assert found == [(0, 0, 0, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, 4, True), (4, 1, 4, True)]
