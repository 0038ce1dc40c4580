"""Session settings the library counts on, and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from codetide.sources.files import delete

# Settings worth having on any session that runs these jobs.  Nothing here is
# required for right results; they shape partition sizes and join planning.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    # splits the hot side of a sort-merge lookup into several tasks
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # one Arrow row is a whole source file on the way into the flattener
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}

_FALLBACK_ROOTS: dict[str, str] = {}
# per application, the paths handed out under the shared folder and not given back yet
_IN_USE: dict[str, set[str]] = {}


def local_session(cores: int | str = "*", app: str = "codetide", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder: there the
    driver's disk is every executor's disk.  A cluster session without the
    setting is an error, since a machine-local path would be lost with its host.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK_ROOTS:
        _FALLBACK_ROOTS[app] = tempfile.mkdtemp(prefix="codetide-")
    return _FALLBACK_ROOTS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used; ``release_all`` gives it back."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _IN_USE.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def release(spark: SparkSession, path: str) -> None:
    """Delete a path that ``fresh_path`` gave; frames that still read it are of no use afterwards."""
    delete(spark, path)
    _IN_USE.get(spark.sparkContext.applicationId, set()).discard(path)


def release_all(spark: SparkSession) -> None:
    """Delete all staged tables of this application: between queries whose results are read."""
    for path in sorted(_IN_USE.get(spark.sparkContext.applicationId, ())):
        release(spark, path)


# ids are hex digits: only a codec that counts symbols brings them near their 32 bytes
CODEC = "zstd"


def stage(df: DataFrame, label: str, area: StagingArea | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read the same expensive rows.  The table cuts
    the lineage, outlives any executor, and lets every branch scan only the
    columns it names.
    """
    path = area.path(label) if area else fresh_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class StagingArea:
    """A folder for the staged tables of one run, given back as a whole when it is over.

    With a ``root`` of its own the tables are there to stay, each under the name of its label.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.root = root or fresh_path(spark, "staging")
        self._named = root is not None
        self._count = 0

    def path(self, label: str) -> str:
        if self._named:
            return f"{self.root}/{label}"
        self._count += 1
        return f"{self.root}/{self._count:02d}-{label}"

    def read(self, spark: SparkSession, label: str) -> DataFrame:
        return spark.read.parquet(self.path(label))

    def release(self) -> None:
        """Delete the staged tables; frames that still read them are of no use afterwards."""
        release(self.spark, self.root)
