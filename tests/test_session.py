"""Staged tables go when they are released."""

from codetide.session import StagingArea, fresh_path, release, stage
from codetide.sources.files import exists


def test_released_tables_are_gone(spark):
    area = StagingArea(spark)
    stage(spark.range(3), "one", area)
    lone = fresh_path(spark, "lone")
    spark.range(2).write.parquet(lone)
    assert exists(spark, area.root) and exists(spark, lone)
    area.release()
    release(spark, lone)
    assert not exists(spark, area.root) and not exists(spark, lone)


def test_all_that_an_application_staged(tmp_path):
    """In a process of its own: other tests still read what they staged."""
    import subprocess
    import sys

    code = """
from codetide.session import local_session, release_all, shared_root, stage
import os
spark = local_session(1, **{"spark.checkpoint.dir": %r})
spark.sparkContext.setLogLevel("ERROR")
stage(spark.range(3), "a"); stage(spark.range(3), "b")
staged = lambda: [n for n in os.listdir(shared_root(spark)) if n[:2] in ("a-", "b-")]
assert len(staged()) == 2
release_all(spark)
assert staged() == []
""" % str(tmp_path)
    import pathlib

    subprocess.run([sys.executable, "-c", code], check=True, timeout=180, cwd=pathlib.Path(__file__).parent.parent)
