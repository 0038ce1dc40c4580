from pyspark.sql import functions as F

from codetide.plans.catalog.streams import landing_archive


def test_a_drop_whose_first_task_has_no_rows_is_archived_whole(spark, tmp_path):
    # a file of its own for each drop's days, the largest first: tasks are dealt by size, and the first
    # task of the later drops writes an empty file
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for part, (first, size) in enumerate(((0, 6000), (6000, 300), (6300, 100))):
        day = F.lit(10 * part) + F.expr(f"cast((id - {first}) * 10 div {size} as int)")
        spark.range(first, first + size, 1, 1).select(
            F.col("id").alias("event_id"),
            (start + F.make_dt_interval(day)).cast("timestamp_ntz").alias("ts"),
            (F.col("id") % 7).alias("user_id"),
            F.lit("click").alias("event_type"),
            F.lit("{}").alias("props"),
        ).write.parquet(str(tmp_path / f"events.parquet/part={part}"))
    got = {r["_id"]: r["event_id"] for r in landing_archive(spark, str(tmp_path)).collect()}
    assert got == {str(u): max(e for e in range(6400) if e % 7 == u) for u in range(7)}
