import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from codetide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="codetide-tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def corpus(spark):
    def make(files: dict, repository: str = "example/repo"):
        rows = [(repository, path, bytearray(body if isinstance(body, bytes) else body.encode())) for path, body in files.items()]
        return spark.createDataFrame(rows, "repository string, file_path string, content binary")

    return make
